"""Train stop-event analytics as PySpark DataFrame and Structured Streaming jobs."""
