"""Device telemetry and change-log replication as plain Spark DataFrame operators."""
