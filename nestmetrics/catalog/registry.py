"""Registry of the queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from nestmetrics.catalog.oracle_views import VIEWS
from nestmetrics.catalog.tables import Market, market

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of a ``Market`` under a name, with the SQL for the same result."""

    def register(build: Callable[[Market], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(market(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = VIEWS + sql
        return build

    return register
