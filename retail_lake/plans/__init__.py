"""Whole jobs: the lake facade, the ingest cycle and the registered queries."""
