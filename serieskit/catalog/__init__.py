"""All registered queries."""

from serieskit.catalog import cluster_queries, demand_queries, model_queries, price_queries  # noqa: F401
from serieskit.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
