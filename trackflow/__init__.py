"""Spark-native analytics for position tracks and the operational tables around them."""
