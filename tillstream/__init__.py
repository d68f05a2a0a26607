"""Spark-native analytics over e-commerce event streams."""
