"""spanframe: a PySpark-native engine for time-stamped text and the corpora made from it."""
