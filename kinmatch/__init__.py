"""Spark-native multi-source entity resolution."""
