"""Operators of a training-data pipeline: mixing, deduplication, counting, cleaning.

Nothing else in the library imports this subpackage.
"""
