"""Column expressions: row-hash keys and key/path handling."""
