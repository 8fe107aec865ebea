"""Structured Streaming scoring."""
