"""Spark-native ingestion and analytics for model-evaluation and training-run data."""
