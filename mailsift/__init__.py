"""Mail and text classification analytics as Spark DataFrame operators."""
