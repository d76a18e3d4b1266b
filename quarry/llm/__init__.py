"""Operators for preparing large text corpora (deduplication, filtering, tokenising, sharding).

Nothing else in the library imports this subpackage.
"""
