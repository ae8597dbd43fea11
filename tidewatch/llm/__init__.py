"""Operators on text corpora and similarity; nothing else in the library imports this package."""
