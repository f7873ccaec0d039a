"""Operators for text corpora and training data; their queries are in ``catalog``."""
