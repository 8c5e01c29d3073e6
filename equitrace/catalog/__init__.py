"""Registered queries over the test tables, with their check SQL."""

from equitrace.catalog import (  # noqa: F401
    model_queries,
    sales_queries,
    score_queries,
    validate_queries,
)
from equitrace.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
