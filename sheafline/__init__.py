"""Dataset-metadata harvesting analytics expressed as Spark DataFrame jobs."""
