"""Clinical-record migration and analytics as Spark DataFrame jobs."""
