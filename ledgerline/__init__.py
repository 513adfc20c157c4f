"""Revenue recognition and transaction analytics as Spark DataFrame operators."""
