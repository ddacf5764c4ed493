"""Spark building blocks for loading, reshaping, checking and summarising tables."""

__version__ = "0.1.0"
