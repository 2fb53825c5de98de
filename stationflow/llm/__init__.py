"""Operators for preparing training text: filters, duplicates, scoring and mixing."""
