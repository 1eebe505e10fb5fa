"""Event analytics as Spark DataFrame functions, for batch and Structured Streaming."""
