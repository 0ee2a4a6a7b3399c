"""Structured Streaming jobs over arriving responses."""
