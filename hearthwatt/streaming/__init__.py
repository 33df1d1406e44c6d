"""Structured Streaming jobs: the same operators on rows that keep arriving."""
