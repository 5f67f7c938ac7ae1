"""Structured Streaming forms of the window counters."""
