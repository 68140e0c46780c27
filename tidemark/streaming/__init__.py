"""Structured Streaming entry points: the same steps, driven by a file stream."""
