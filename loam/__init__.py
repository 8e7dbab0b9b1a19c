"""loam: a Spark-native engine that curates large training datasets."""
