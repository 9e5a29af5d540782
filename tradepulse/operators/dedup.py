"""One row per key, by a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of every key.

    ``order`` lists descending sort columns. Every remaining column breaks ties,
    so the survivor never depends on how rows arrived. Spark keeps one row per
    key and task before it shuffles (window group limit), hence a key that holds
    most rows does not fill one task.
    """
    ties = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def _by_arrival() -> list[Column]:
    return [F.col("event_ts").desc_nulls_last(), F.col("src_offset").desc_nulls_last()]


def dedup_orders(orders: DataFrame, day: Sequence[str] = ("business_date",)) -> DataFrame:
    return last_per_key(orders, [*day, "order_id"], _by_arrival())


def dedup_fills(fills: DataFrame, day: Sequence[str] = ("business_date",)) -> DataFrame:
    return last_per_key(fills, [*day, "order_id", "fill_id"], _by_arrival())


def dedup_otc(otc: DataFrame, day: Sequence[str] = ("business_date",)) -> DataFrame:
    return last_per_key(otc, [*day, "op", "order_id"], _by_arrival())


def dedup_requests(requests: DataFrame, day: Sequence[str] = ("business_date",)) -> DataFrame:
    """Per operation and id; an INSERT must carry its own business date."""
    kept = requests.where("op <> 'INSERT' OR request_date = business_date")
    return last_per_key(kept, [*day, "op", "request_id"], _by_arrival())
