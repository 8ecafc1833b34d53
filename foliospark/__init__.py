"""A Spark-native engine for page- and document-shaped text."""
