"""Column functions; all are built from Spark's own, so they stay inside generated code."""
