"""Spark-native data-science operators."""
