"""Spark-native analytics over document corpora."""
