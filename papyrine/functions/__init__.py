"""Column functions: built-in Spark expressions only, no Python workers."""
