"""riskframe: binary risk scoring on tables and streams, on Spark."""

__version__ = "0.1.0"
