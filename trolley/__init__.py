"""Retail-basket analytics on Spark: ingest, clean, serve and query order items."""
