"""Spark-native analytics over timed text and the documents around it."""
