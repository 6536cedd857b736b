"""Spark-native record linkage, explainable scoring and corpus preparation."""
