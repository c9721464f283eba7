"""Spark-native operators for risk-driven prioritisation of large record catalogues."""
