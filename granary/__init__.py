"""granary: Spark-native preparation of retrieval corpora."""
