"""Whole loads and the keyed target table."""
