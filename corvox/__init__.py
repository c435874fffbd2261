"""Corvox: a PySpark-native engine for preparing and auditing speech/text corpora."""
