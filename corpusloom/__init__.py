"""A Spark-native engine for building text corpora from web pages."""
