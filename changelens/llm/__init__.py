"""Operators for preparing training data: cleaning, deduplication, mixing,
tokenising and formatting of large document collections."""
