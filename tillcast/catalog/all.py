"""Import every query module so the registry is complete."""

from tillcast.catalog import queries_core, queries_features, queries_forecast, queries_plan, queries_reports, queries_models, queries_extra  # noqa: F401
from tillcast.catalog.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
