"""Analytics over account statements on Spark: ingest, typing, quality, spend, recurring charges."""

__version__ = "0.1.0"
