"""Structured Streaming add into a stored index."""
