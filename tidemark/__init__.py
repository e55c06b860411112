"""Change-log and trip analytics as plain Spark DataFrame operators."""
