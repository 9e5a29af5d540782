"""All registered queries with their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradepulse.plans import activity, cdc, streams, trade

Query = Callable[[SparkSession, str], DataFrame]

ENTRIES: dict[str, tuple[Query, str | None]] = {
    **trade.QUERIES,
    **activity.QUERIES,
    **cdc.QUERIES,
    **streams.QUERIES,
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql is not None}
