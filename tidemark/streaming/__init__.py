"""Structured Streaming: landing arriving events in bronze, and bronze to silver."""
