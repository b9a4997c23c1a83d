"""changeflow: change-data-capture as Spark DataFrame and Structured Streaming jobs."""
