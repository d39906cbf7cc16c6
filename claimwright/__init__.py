"""Spark-native lakehouse jobs for claims data: Bronze, Silver, Gold and analytics."""

__version__ = "0.1.0"
