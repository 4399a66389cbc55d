"""Fleet, road and collection-plan analytics as Spark DataFrame jobs."""
