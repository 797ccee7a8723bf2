"""Column helpers: every function here takes and returns Spark Columns."""
