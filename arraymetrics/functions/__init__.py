"""Part of the telemetry engine."""
