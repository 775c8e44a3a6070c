"""DataFrame operators that Spark has no single word for."""
