"""Structured Streaming form of the page landing."""
