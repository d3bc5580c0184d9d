"""Spark-native analytics for lookup dictionaries built from wiki pages."""
