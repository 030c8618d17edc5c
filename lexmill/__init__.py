"""Spark-native corpus building and auditing."""
