"""Spark-native star-schema mart over two catalogue and community sources."""
