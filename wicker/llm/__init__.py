"""Operators for preparing training data at scale.

Nothing outside this subpackage imports it.  Each operator takes and returns
DataFrames; per-row work that built-in functions cannot express runs in Arrow
batches inside Spark tasks.
"""
