"""Registered queries over the driver's tables, each beside its SQL."""

from demandtide.catalog import (  # noqa: F401
    features,
    forecasts,
    kpis,
    masters,
    prep,
    relational,
    scalars,
    sources,
    splits,
)
from demandtide.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
