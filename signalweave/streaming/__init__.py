"""Structured Streaming forms of the state comparisons."""
