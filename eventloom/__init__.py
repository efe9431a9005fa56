"""Spark-native feature, alignment, sampling and evaluation operators for event logs."""
