"""Spark-native analytics for technical-document corpora."""
