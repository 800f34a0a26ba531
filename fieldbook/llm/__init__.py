"""Operators for preparing training corpora: tokenising, mixing, searching and deduplicating text."""
