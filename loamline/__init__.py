"""Spark-native analytics for building and auditing large text corpora."""
