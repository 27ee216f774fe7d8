"""Relational operators: DataFrames in, DataFrames out.

They run nothing themselves, except ``rollup.quantiles``, which counts in rounds.
"""
