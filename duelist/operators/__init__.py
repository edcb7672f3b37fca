"""Operators: DataFrames in, DataFrames out; column names are parameters."""
