"""Readers of landed files, and parsers from raw records to papers."""
