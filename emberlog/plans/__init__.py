"""Registered queries over the given tables."""

from emberlog.plans import analytics, flagship, projections, rules, searches, tables  # noqa: F401
from emberlog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
