"""Network-telemetry roll-ups on Spark."""
