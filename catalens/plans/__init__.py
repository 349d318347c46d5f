"""Queries over the sample tables, each with the SQL that says the same."""
