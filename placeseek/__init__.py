"""Document search and corpus analytics for place-related articles, as Spark jobs."""
