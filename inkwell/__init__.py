"""inkwell: a PySpark-native engine for mining collections of scientific papers."""
