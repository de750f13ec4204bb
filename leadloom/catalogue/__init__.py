"""Every operator and report as a query on the provided tables, with its plain SQL form."""

from . import aggregates, joins, rankings, reports, scalars, scans  # noqa: F401  (fill the registry)
from .registry import QUERIES, oracle_sql, queries

__all__ = ["QUERIES", "oracle_sql", "queries"]
