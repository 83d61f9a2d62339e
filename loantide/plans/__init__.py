"""Data products: each function takes DataFrames and an as-of date and returns one lazy DataFrame."""
