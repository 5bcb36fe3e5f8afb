"""Spark-native processing of incrementally updated metadata tables."""
