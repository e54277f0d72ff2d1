"""Spark-native instrument reference-data, basket and minute-bar engine."""
