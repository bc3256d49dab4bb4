"""confluo: record fusion and corpus preparation as declarative Spark plans."""
