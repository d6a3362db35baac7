"""leafmark: document analytics expressed as Spark DataFrame and SQL plans."""
