"""Ocean-observation analytics as Spark DataFrame jobs."""
