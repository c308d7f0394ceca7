"""Spark-native engine for genome-wide association data work."""
