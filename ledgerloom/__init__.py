"""Spark-native operators and jobs for insurance tables and value-mapping rules."""

__version__ = "0.1.0"
