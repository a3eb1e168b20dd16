"""Card-transaction analytics as Spark DataFrame functions."""
