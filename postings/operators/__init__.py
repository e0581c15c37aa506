"""Operators: DataFrames and options in, a DataFrame out."""
