"""Operators for building training corpora.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; Python runs only inside Spark tasks, on Arrow batches, and
holds at most one bounded block of rows at a time.
"""
