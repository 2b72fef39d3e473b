"""Operators for preparing training text: filters, near duplicates, scores, mixes and files."""
