"""Spark-native manufacturing analytics: clean tables, audits, marts, metrics."""
