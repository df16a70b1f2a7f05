"""The catalogue of registered queries with their SQL counterparts."""

from cardwarden.catalog import feature_queries, ingest, large_plans, model_queries, quality_queries  # noqa: F401
from cardwarden.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
