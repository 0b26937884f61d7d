"""A PySpark-native analytics engine for document-derived knowledge."""
