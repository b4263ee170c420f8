"""Operators on training text: deduplication, filters, scans, sharding and packing.

Nothing else in the library imports this package. Shared rules: operators read only the
columns they name, so other columns may be called anything; a null text is an empty one or has
no words, as each docstring says; repeated rows are rows of their own.
"""
