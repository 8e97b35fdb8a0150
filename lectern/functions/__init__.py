"""Column expressions, and Arrow-batched functions for what Spark has no expression for."""
