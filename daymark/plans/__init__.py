"""The queries: operators applied to the given tables, each with its SQL counterpart."""

from __future__ import annotations

from . import activity, analytics, experiments, history, matches, quality, sessions, stored, versions, visitors

MODULES = (activity, history, analytics, sessions, matches, quality, experiments, stored, versions, visitors)


def queries() -> dict:
    """Query name to ``(spark, folder) -> DataFrame``."""
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict:
    """Query name to SQL that gives the same rows."""
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
