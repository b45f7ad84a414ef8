"""Spark-native retail analytics: typed ingestion, marts, indicators and data quality."""
