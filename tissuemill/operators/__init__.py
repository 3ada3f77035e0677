"""Operators on imaging tables: DataFrames in, DataFrames out."""
