"""sparkpipe: trip-record and market-tick data pipelines as Spark DataFrame jobs."""

__version__ = "0.1.0"
