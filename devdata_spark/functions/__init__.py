"""Column expressions: each takes and returns a Spark `Column`."""
