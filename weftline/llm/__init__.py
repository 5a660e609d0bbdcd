"""Operators for training-data pipelines: sharding, mixing, deduplication, classifiers, scans.

Nothing else in the library imports this subpackage. ``queries`` and ``oracles`` hold what
``__spark_entry__`` registers.
"""
