"""Spark-native engine for storage-array telemetry."""
