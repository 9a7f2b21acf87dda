"""Spark-native building, verifying and analysing of instruction-following data."""
