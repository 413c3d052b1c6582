"""Importing this module registers every query."""

from workload import (  # noqa: F401
    column_queries,
    episode_queries,
    key_queries,
    layout_queries,
    quality_queries,
    report_queries,
    tables_queries,
)
