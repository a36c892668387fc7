"""Structured Streaming variants of the repeat-run operators."""
