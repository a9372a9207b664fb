"""Air-quality analytics as Spark DataFrame operators."""
