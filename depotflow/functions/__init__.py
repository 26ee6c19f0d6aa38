"""Column helpers built only from Spark's own functions."""
