"""Readers and writers: typed CSV/parquet tables, the test-table view, sinks."""

from cinerank.sources.files import (
    CATALOG_COLUMNS,
    RATINGS_COLUMNS,
    read_catalog,
    read_ratings,
    reject_counts,
    rejected_catalog,
    rejected_ratings,
)
from cinerank.sources.sinks import write_recommendations, write_report
from cinerank.sources.testdata import catalog_view, load_tables, ratings_view

__all__ = [
    "CATALOG_COLUMNS",
    "RATINGS_COLUMNS",
    "read_catalog",
    "read_ratings",
    "reject_counts",
    "rejected_catalog",
    "rejected_ratings",
    "write_recommendations",
    "write_report",
    "catalog_view",
    "load_tables",
    "ratings_view",
]
