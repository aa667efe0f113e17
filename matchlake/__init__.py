"""Spark-native tables, features, models and monitoring for match data."""
