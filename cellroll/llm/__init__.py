"""Operators for building training data: search, filters, duplicates, tokens.

Every operator takes and returns DataFrames.  Text work inside tasks runs on
Arrow batches with numpy; Spark does the partitioning, shuffling and joining.
"""
