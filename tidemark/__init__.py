"""tidemark: daily price-panel analytics expressed as Spark DataFrame plans."""
