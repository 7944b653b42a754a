"""Operators for preparing training text: deduplication, mixing, tokenizing,
formatting, scoring and search. Nothing else in the package imports this."""
