"""Structured Streaming sessions and their sinks."""
