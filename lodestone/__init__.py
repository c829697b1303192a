"""A Spark-first retrieval and document-analytics engine."""
