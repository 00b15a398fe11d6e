"""The queries of this subpackage and their SQL."""

from hailgrid.llm import queries  # noqa: F401  (fills the registry)
from hailgrid.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
