"""Operators for preparing training data: dedup, classification, mixing, filters, tokenization.

Nothing else in the library imports this subpackage; ``catalog`` registers its queries.
"""
