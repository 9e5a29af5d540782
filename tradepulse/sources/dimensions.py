"""Dimension snapshots and the trading calendar.

No join here or downstream forces a broadcast: Spark broadcasts a dimension when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions.expressions import currency_key


def latest_snapshot(history: DataFrame, month: str = "month_id", day: str = "day_id") -> DataFrame:
    """Rows of the newest (month, day) partition.

    The newest date is a scalar subquery, so the scan of the kept rows is pruned
    by partition when the table is partitioned by these columns.
    """
    stamp = F.concat(F.col(month).cast("string"), F.col(day).cast("string"))
    newest = history.select(F.max(stamp).alias("newest"))
    return history.where(stamp == newest.scalar())


def latest_rates(history: DataFrame, currency: str = "bz", rate: str = "gsbl") -> DataFrame:
    """Newest exchange rates as (currency, rate), one row per currency key.

    Keys are trimmed and upper-cased; should two spellings collide, the larger
    rate is kept so that the result does not depend on row order.
    """
    snapshot = latest_snapshot(history)
    return (
        snapshot.groupBy(currency_key(currency).alias("currency"))
        .agg(F.max(F.col(rate).cast(S.RATE)).alias("rate"))
    )


def latest_products(
    history: DataFrame, prod_id: str = "id", issuer: str = "fxjg", prod_type: str = "cplx"
) -> DataFrame:
    """Newest product dimension as text (prod_id, issuer, prod_type), one row per id."""

    def key(name: str) -> Column:
        return F.upper(F.trim(F.col(name).cast("string")))

    details = F.struct(key(issuer).alias("issuer"), key(prod_type).alias("prod_type"))
    return (
        latest_snapshot(history)
        .groupBy(key(prod_id).alias("prod_id"))
        .agg(F.max(details).alias("d"))
        .select("prod_id", "d.issuer", "d.prod_type")
    )


def next_trade_day(calendar: DataFrame, business_date: int, day: str = "jyr") -> DataFrame:
    """The first calendar day after ``business_date``, one row."""
    return calendar.where(F.col(day) > business_date).agg(
        F.min(F.col(day).cast("int")).alias("next_trade_day")
    )
