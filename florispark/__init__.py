"""Spark-native analytics for ingredient knowledge bases and text corpora."""
