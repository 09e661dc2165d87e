"""Spark-native document-to-graph engine."""
