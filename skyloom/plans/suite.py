"""All registered queries."""

from skyloom.plans import (  # noqa: F401
    suite_bulk,
    suite_catalogue,
    suite_cubes,
    suite_grid,
    suite_lifecycle,
    suite_observations,
    suite_planning,
    suite_requests,
    suite_rules,
    suite_streaming,
)
from skyloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
