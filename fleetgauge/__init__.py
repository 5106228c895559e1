"""Fleet telemetry analytics on Spark: samples in, health rows per server and month out."""
