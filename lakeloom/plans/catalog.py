"""All named queries over the driver's tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from . import functions, measures, scans, tables, upserts  # noqa: F401  each registers its queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
