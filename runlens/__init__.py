"""Spark-native analytics over workflow-run archives."""

__version__ = "0.1.0"
