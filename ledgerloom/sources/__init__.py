"""Readers of the raw feeds and writers of the target tables."""
