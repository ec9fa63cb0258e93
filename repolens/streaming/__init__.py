"""Incremental loading of newly landed pages with Structured Streaming."""
