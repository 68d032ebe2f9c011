"""Column functions: every one is a composition of Spark's own expressions."""
