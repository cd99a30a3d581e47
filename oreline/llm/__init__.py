"""Operators of a training-data pipeline: filter, deduplicate, mix, shard, encode.

Nothing else in the library imports this package.
"""
