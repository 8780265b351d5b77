"""Short-term-rental market analytics as Spark DataFrame jobs."""
