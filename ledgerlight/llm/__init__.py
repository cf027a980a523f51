"""Operators for training corpora: deduplication, filters, scores and mixing."""
