"""Lambda-style sales analytics on Spark."""
