"""Readers, payload parsers and writers."""
