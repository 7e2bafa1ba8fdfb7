"""paralith: a PySpark-native engine for parallel and multilingual text corpora."""
