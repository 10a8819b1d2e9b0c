"""Spark-native processing of document and event collections."""
