"""Named queries over the test tables, each beside the SQL that must give the same rows."""

from hailgrid.catalog import allocation, dashboards, forecasts, series, trips  # noqa: F401  (fill the registry)
from hailgrid.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
