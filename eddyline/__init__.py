"""Spark-native analytics over user-behaviour event data, batch and streaming."""
