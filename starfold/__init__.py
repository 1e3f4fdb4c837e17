"""Star-catalog preparation and survey target lists as Spark DataFrame jobs."""
