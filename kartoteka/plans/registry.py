"""Where queries register themselves, each with DuckDB SQL where that can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, its SQL."""

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


from kartoteka.plans import catalog, clubs, inputs, relational, reports, resolution, scalars  # noqa: E402, F401  they register their queries
