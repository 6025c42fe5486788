"""Customer analytics for business-to-business data, as Spark DataFrame jobs."""
