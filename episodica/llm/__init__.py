"""Operators for training-data pipelines: filtering, deduplication, search, scoring and mixing of texts.

Each module holds one operator on DataFrames with its column names as arguments; ``queries`` binds them
to the given tables.  Operators without the word "native" in their docstring run vectorised Python
on Arrow batches inside Spark tasks; what they broadcast is bounded by a parameter.
"""
