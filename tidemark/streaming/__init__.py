"""Sinks and stateful wiring for Structured Streaming."""
