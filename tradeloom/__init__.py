"""Commerce analytics as plain Spark DataFrame functions."""
