"""Operators that prepare text corpora for training: deduplication, scoring, archives, privacy, mixing, encoding.

Nothing else in the library imports this package.
"""
