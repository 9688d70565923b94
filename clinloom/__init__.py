"""Spark-native standardisation and training-data engine for clinical records."""
