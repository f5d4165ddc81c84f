"""Title-block analytics on Spark."""
