"""Public-record analytics as Spark DataFrame jobs."""
