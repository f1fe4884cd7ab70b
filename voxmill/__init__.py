"""A PySpark-native engine for speech corpora and their metrics."""
