"""Column expressions: each takes and returns Spark columns, no Python per row."""
