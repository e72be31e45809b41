"""Spark-native road-safety analytics: every operator takes DataFrames and
returns a lazy DataFrame (or Column); Catalyst plans the work."""

__version__ = "0.1.0"
