"""A Spark-native engine for drawing and specification analytics."""
