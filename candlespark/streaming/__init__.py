"""Structured Streaming jobs over the trade stream."""
