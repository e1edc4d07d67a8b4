"""Spark-native analytics over dated, labelled free-text records."""
