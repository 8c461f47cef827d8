"""Operators on DataFrames: profiling, keys, running sums, upsert, reconciliation, audit."""
