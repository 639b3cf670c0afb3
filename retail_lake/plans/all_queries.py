"""Imports every module that registers queries."""

from retail_lake.plans import (  # noqa: F401
    access_queries, audit_queries, ingest_queries, lake_queries, quality_queries, status_queries, storage_queries,
)
from retail_lake.plans.registry import CHECKS, QUERIES  # noqa: F401
