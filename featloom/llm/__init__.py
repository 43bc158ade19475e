"""Operators for preparing training text: filters, near-duplicates, archives, private data, mixing.

Nothing else in the library imports this package.
"""
