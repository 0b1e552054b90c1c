"""The query catalogue: each entry pairs a Spark plan over the given tables with its SQL twin."""

from tradeflow.plans.catalog import decisions, drift, gold, models, monitoring, silver, sources, streams, tables  # noqa: F401
from tradeflow.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
