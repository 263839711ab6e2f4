"""Structured Streaming sources, sinks and flows."""
