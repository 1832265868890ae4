"""A PySpark-native analytics engine for bibliographic and document corpora."""
