"""Structured Streaming intake of new snapshot files."""
