"""martloom: dimensional-mart loading, auditing and quality checks as Spark DataFrame jobs."""
