"""Transit-operations analytics as Spark jobs: trips, headways, telemetry, history tables, audits."""

__version__ = "0.1.0"
