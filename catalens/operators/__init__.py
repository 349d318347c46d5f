"""Catalog operators: each takes and returns DataFrames."""
