"""Spark-native on-time analytics."""
