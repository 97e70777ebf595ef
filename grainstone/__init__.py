"""Spark-native analytics over Ion data, with relational work left to Catalyst."""

__version__ = "0.1.0"
