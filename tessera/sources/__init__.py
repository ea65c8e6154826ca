"""Readers and writers of the engine's files, and its fixed dimension tables."""
