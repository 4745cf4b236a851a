"""PySpark-native analytics over review and rating tables."""
