"""Column-level functions (built-in Spark expressions only, no Python UDFs)."""
