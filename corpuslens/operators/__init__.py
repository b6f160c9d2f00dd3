"""The operators: DataFrames in, DataFrame out."""
