"""weftline: a PySpark-native engine for ordered text corpora."""
