"""Utility-metering analytics on Spark: staging, rollups, reports, streams."""

__version__ = "0.1.0"
