"""Spark-native preparation and measurement of language-model training corpora."""

__version__ = "0.1.0"
