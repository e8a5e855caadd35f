"""Retail medallion analytics on PySpark: ingest, conform, measure, report."""

__version__ = "0.1.0"
