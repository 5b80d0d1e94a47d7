"""Operators for preparing training text: deduplication, archives, language, privacy, tokens, quality, mixing, leaks, extraction."""
