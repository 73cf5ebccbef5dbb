"""Sales analytics and model monitoring as Spark DataFrame jobs."""
