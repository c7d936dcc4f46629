"""gridsky: electricity and weather telemetry analytics on Apache Spark."""

__version__ = "0.1.0"
