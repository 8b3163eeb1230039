"""Commerce change-data and analytics jobs on Apache Spark."""

__version__ = "0.1.0"
