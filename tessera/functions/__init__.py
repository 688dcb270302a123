"""Column-level building blocks (pure Spark expressions, no UDFs)."""
