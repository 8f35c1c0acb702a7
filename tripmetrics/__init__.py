"""Ranking jobs over trip tables, as plain DataFrame expressions."""

__version__ = "0.1.0"
