"""Catalens: catalog analytics as Spark DataFrame operators."""
