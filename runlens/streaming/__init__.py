"""Structured Streaming twins of the log operators."""
