"""Structured Streaming variant of the incremental feed load."""
