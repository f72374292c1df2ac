"""Operators for text used as training data. Nothing else in the library imports this package."""
