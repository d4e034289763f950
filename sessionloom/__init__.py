"""Spark-native engine that builds aligned speech-text corpora from session records."""
