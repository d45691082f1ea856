"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainloom.sources.ledger import VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: bool = True) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` may use the ledger views."""

    def add(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            body = sql.strip()
            ORACLES[build.__name__] = (VIEWS + (", " + body[5:] if body.upper().startswith("WITH ") else body)) if views else body
        return build

    return add
