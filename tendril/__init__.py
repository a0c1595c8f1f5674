"""tendril: a Spark-native feature engine for entity and event tables."""
