"""Operators that prepare text, embeddings and pages as training data."""
