"""Keep analytical tables in step with their sources, as Spark jobs."""
