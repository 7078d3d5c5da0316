"""Structured Streaming gate for tick events."""
