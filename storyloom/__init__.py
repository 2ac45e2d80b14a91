"""A PySpark-native engine for conversational and narrative text corpora."""
