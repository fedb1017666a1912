"""Operators for preparing training data: quality, search, archives, duplicates, packing,
tokens, personal data and licences. Nothing else in the library imports this package."""
