"""Declared-versus-observed reconciliation over DataFrames.

Every operator takes and returns DataFrames and handles all subjects at
once. See ``README.md`` for the map of the package.
"""
