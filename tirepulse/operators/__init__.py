"""Operators: each takes report DataFrames and returns a lazy DataFrame."""
