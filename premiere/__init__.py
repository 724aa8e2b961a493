"""Spark-native analytics for product launches and transaction risk."""
