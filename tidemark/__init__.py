"""Spark-native analytics for semi-structured support-desk data."""
