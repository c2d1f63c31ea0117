"""Operators for training-data pipelines over a corpus of documents."""
