"""Operators for preparing training text: filters, deduplication and mixing."""
