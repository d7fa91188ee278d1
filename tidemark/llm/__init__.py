"""Operators for large text corpora: quality, language, duplicates, tokens, secrets, leaks."""
