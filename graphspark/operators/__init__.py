"""Operators: DataFrames in, DataFrame out (a table of questions at a time)."""
