"""Spark-native star-schema refresh and commercial reports."""
