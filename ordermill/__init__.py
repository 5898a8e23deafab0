"""ordermill — a Spark-native daily retail order pipeline and reports."""

__version__ = "0.1.0"
