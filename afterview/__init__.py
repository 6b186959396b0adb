"""Afterview: a Spark-native engine for cross-device advertising attribution."""
