"""Registered queries: each runs on a folder of test tables and may have SQL to check it."""

from riskmart.catalog.base import ORACLE, QUERIES

from riskmart.catalog import (  # noqa: F401  (importing registers the queries)
    cleaning,
    datamart,
    governance,
    metrics,
    models,
    monitoring,
    quality,
    stability,
)

__all__ = ["ORACLE", "QUERIES"]
