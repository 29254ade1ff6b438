"""Incremental file loads as Structured Streaming queries."""
