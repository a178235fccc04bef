"""Equipment-telemetry analytics expressed as Spark DataFrame transformations."""
