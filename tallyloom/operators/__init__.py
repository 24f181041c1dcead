"""Relational operators: DataFrames and parameters in, a lazy DataFrame out."""
