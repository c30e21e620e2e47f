"""Reusable operators: DataFrames in, a DataFrame out."""
