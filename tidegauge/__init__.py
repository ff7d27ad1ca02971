"""Spark-native log analytics: loads, totals, trends and drift monitoring."""
