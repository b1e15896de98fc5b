"""Preference, judging and evaluation data work on PySpark."""

__version__ = "0.1.0"
