"""Registered queries over the given tables, with the SQL that checks them."""

from millrace.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    filters,
    joins,
    planning,
    projections,
    scalars,
    scans,
    sets,
    stats,
    tables,
    text,
    workloads,
)
from millrace.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
