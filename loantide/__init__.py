"""Portfolio risk analytics expressed as Spark DataFrame plans."""
