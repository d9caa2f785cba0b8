"""Operators that prepare training data: filters, dedup, packing, search and extraction."""
