"""Operators for preparing training text: tokens, duplicates, quality, privacy."""
