"""Structured Streaming queries and the two-stream application."""
