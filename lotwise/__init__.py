"""Used-car listings analytics as Spark DataFrame jobs."""
