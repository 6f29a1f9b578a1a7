"""Spark-native analytics for rare-failure risk on tables of any size."""

__version__ = "1.0.0"
