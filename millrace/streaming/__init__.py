"""Structured Streaming jobs over the same logic."""
