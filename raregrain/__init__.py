"""Spark-native tabular analytics and rare-event classification."""
