"""Operators for preparing training data: filtering, deduplication, scoring and mixing of documents."""
