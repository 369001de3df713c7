"""Spark-native analytics over documents: canonical nodes, governance, chunks, retrieval and training-data operators."""
