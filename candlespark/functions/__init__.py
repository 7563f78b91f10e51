"""Column expressions: built-in Spark functions only, so that they stay inside generated code."""
