"""All queries of the engine."""

from __future__ import annotations

from . import annotation_queries, consensus_queries, file_queries, interval_queries, misc_queries, model_queries  # noqa: F401
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
