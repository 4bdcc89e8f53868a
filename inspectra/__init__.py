"""Spark-native visual-inspection analytics."""
