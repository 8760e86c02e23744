"""Sales analytics for outlet exports, expressed as Spark DataFrame operators."""
