"""All runnable queries."""

from kinweave.catalog.registry import QUERIES
from kinweave.catalog import (  # noqa: F401
    behavior_queries, ingest_queries, matching_queries, metadata_queries, report_queries, resolution_queries, stream_queries,
    vector_queries,
)

__all__ = ["QUERIES"]
