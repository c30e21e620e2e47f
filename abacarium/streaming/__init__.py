"""Incremental forms of the load operators on Structured Streaming."""
