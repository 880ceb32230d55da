"""Arrival-driven loads on Structured Streaming."""
