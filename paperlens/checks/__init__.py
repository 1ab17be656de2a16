"""Every operator over the given tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None):
    """Register a query under its name, with its SQL where SQL can express it."""

    def add(query: Query) -> Query:
        key = name or query.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql.strip()
        return query

    return add


def load_all() -> None:
    from . import (  # noqa: F401
        aggregates,
        drift,
        evaluation,
        feed,
        files,
        filters,
        flows,
        joins,
        merges,
        scalars,
        streams,
        training,
    )
