"""Spark-native cleaning, enrichment, loading and reporting for retail-banking data."""
