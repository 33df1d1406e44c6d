"""Readers and writers. Paths are on storage that every executor sees."""
