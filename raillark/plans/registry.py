"""The registered transit queries and the SQL text that a second engine runs."""

from __future__ import annotations

from raillark.plans import catalogue_expr, catalogue_jobs, catalogue_joins, catalogue_rows, catalogue_sources  # noqa: F401
from raillark.plans.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
