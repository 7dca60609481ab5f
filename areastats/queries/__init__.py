"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from areastats.queries import combining, preparation, rates, regression, rows, tables
from areastats.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "combining", "preparation", "rates", "regression", "rows", "tables"]
