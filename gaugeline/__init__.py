"""gaugeline: device-telemetry refinement and connection-health analytics on Spark."""

__version__ = "0.1.0"
