"""Spark-native engine for building, checking and auditing curated catalogues."""
