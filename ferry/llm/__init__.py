"""Operators of a training-data pipeline: sharding, extraction, filters, deduplication, packing.

Nothing else in the library imports this package.
"""
