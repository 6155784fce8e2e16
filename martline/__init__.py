"""Retail sales marts as Spark DataFrame functions."""

__version__ = "0.1.0"
