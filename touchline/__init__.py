"""touchline: sports-results analytics expressed as Spark DataFrame operators."""
