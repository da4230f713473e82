"""Structured Streaming forms: stateful processors and streaming jobs."""
