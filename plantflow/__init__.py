"""plantflow: industrial telemetry and maintenance analytics as Spark DataFrame jobs."""
