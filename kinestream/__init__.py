"""Motion-stream analytics on Spark."""
