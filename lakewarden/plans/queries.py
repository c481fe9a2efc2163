"""All registered queries; importing a module registers its queries."""

from lakewarden.plans import (  # noqa: F401
    catalog_queries,
    check_queries,
    event_queries,
    model_queries,
    scan_queries,
)
from lakewarden.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
