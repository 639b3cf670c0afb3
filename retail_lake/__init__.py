"""Retail price-file lake on Spark: ingest, access, audit and publish."""
