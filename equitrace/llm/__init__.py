"""Operators for large training corpora, their registered queries and check SQL."""

from equitrace.llm import corpus_queries as _  # noqa: F401 (registers its queries)
from equitrace.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
