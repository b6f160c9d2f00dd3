"""Statement-corpus curation and classifier analytics as Spark jobs."""
