"""Operators for preparing training text: deduplication, filters, scoring and tokenizing."""
