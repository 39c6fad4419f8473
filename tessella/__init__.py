"""Spark-native analytics for corpus manifests."""
