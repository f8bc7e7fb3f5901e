"""Operators for preparing text corpora: identification, counting, deduplication, scanning, packing and sharding.

Nothing else in the package imports this subpackage.
"""
