"""Incremental landing with Structured Streaming (file source, availableNow)."""
