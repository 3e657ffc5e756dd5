"""Structured Streaming variants of the core path (extensions E1-E5)."""
