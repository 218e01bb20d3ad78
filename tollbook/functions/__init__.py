"""Column expressions, all made of Spark built-ins."""
