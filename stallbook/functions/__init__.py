"""Column functions. All are built from Spark expressions; none runs Python per row."""
