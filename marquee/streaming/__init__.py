"""Structured Streaming feeds and their sinks."""
