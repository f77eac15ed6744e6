"""Fleet telemetry analytics expressed as Spark DataFrame and streaming operators."""
