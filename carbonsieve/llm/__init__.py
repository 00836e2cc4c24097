"""Operators for preparing large text corpora: deduplication, extraction, tokens."""
