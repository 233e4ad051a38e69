"""Patient-vitals analytics as Spark DataFrame, Structured Streaming and MLlib operators."""
