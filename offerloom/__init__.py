"""offerloom: a PySpark-native engine for product-catalogue data and text corpora."""
