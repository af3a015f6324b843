"""Structured Streaming forms of the metric operators."""
