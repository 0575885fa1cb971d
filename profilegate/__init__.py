"""Profile ingestion quality on Spark: normalise, check, route and monitor user-profile records."""

__version__ = "0.1.0"
