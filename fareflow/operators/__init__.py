"""Reusable relation operators: DataFrames in, DataFrame out."""
