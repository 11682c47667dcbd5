"""Millrace: a small PySpark-native query package. Plans are built lazily; nothing here collects."""
