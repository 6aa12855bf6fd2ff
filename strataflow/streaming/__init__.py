"""Structured Streaming jobs with injected sources and sinks."""
