"""Structured Streaming form of the table update."""
