"""DataFrame -> DataFrame steps of a load."""
