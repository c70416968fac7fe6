"""Spark-native thermal-comfort climate analytics."""
