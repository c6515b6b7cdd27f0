"""Readers and writers of the engine's files and tables."""
