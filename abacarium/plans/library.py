"""Importing this module registers all named queries."""

from abacarium.plans import histories, joining, ledgers, loads, rankings, rules, selects, streams, totals, upkeep  # noqa: F401
from abacarium.plans.catalog import QUERIES

__all__ = ["QUERIES"]
