"""tracewright: a PySpark-native engine for episode datasets."""
