"""Structured Streaming form of the document queue."""
