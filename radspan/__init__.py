"""Spark-native analytics for imaging-metadata tables and training corpora."""
