"""Named queries over the order-management tables, each with an independent SQL twin."""

from depotflow.registry.base import ENTRIES, oracle_sql, queries

from depotflow.registry import (  # noqa: F401  (importing registers the queries)
    building_blocks,
    cleaning,
    dashboards,
    kpis,
    measures,
    quality,
    warehouse,
)

__all__ = ["ENTRIES", "oracle_sql", "queries"]
