"""Operators for large text corpora: identification, deduplication, mixing, packing.

Nothing else in the package imports this subpackage. Each module holds one
operator with a general interface; ``queries`` holds the thin registered
queries over the given tables.
"""
