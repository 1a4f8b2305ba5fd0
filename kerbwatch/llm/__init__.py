"""Operators for training text: scoring, near-duplicates, redaction, filtering, tokenising, formatting."""
