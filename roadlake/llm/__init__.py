"""Operators for preparing training text: sharding, search, filters, duplicates, tokens and packing."""
