"""Joins that complete a record from another one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E

MATCHED = "matched"


def match_fills(
    fills: DataFrame,
    orders: DataFrame,
    on: Sequence[str] = ("order_id",),
    default: str = S.UNMATCHED_CHANNEL,
    columns: Sequence[str] = ("channel",),
) -> DataFrame:
    """Each fill with its order's channel; ``matched`` tells a hit from a default.

    ``orders`` holds one row per key (an order table, or a state lookup). Only
    the key and the wanted columns of it are shuffled. Both sides enter the join
    straight from their shuffle, so adaptive execution can split the partition
    of an order that holds most fills.
    """
    lookup = orders.select(*on, *columns, F.lit(True).alias(MATCHED))
    out = fills.drop(*columns).join(lookup, list(on), "left")
    out = out.withColumn(MATCHED, F.coalesce(MATCHED, F.lit(False)))
    if "channel" in columns:
        out = out.withColumn("channel", F.coalesce("channel", F.lit(default)))
    return out


#: Fills of one order that a task takes, beyond which its fills are dealt out to more tasks.
HEAVY = 1_000_000


def match_heavy_fills(
    fills: DataFrame,
    orders: DataFrame,
    on: Sequence[str] = ("order_id",),
    heavy: int = HEAVY,
    **kwargs,
) -> DataFrame:
    """:func:`match_fills` where single orders may hold a large share of all fills.

    Fills are counted per order, within tasks first. The fills of an order with more than
    ``heavy`` are dealt out by a hash of all their columns, and that order alone is
    repeated for each share. There are fewer such orders than fills divided by ``heavy``:
    they are counted when this is called, and their ids are broadcast, so that fills never are
    brought together by order alone. Where no order is heavy, the match is the plain one. The
    shares stay even whatever the plan above the join is, where adaptive execution splits only
    joins between two shuffles that nothing else depends on.
    """
    counts = fills.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy)
    shares = counts.select(*on, F.ceil(F.col("_n") / heavy).cast("int").alias("_shares"))
    found = shares.collect()
    if not found:
        return match_fills(fills, orders, on, **kwargs)
    shares = F.broadcast(fills.sparkSession.createDataFrame(found, shares.schema))
    share = F.pmod(F.xxhash64(*fills.columns), F.col("_shares")).cast("int")
    dealt = fills.join(shares, list(on), "left").withColumn("_share", F.coalesce(share, F.lit(0))).drop("_shares")
    last = F.coalesce("_shares", F.lit(1)) - 1
    repeated = orders.join(shares, list(on), "left").withColumn("_share", F.explode(F.sequence(F.lit(0), last))).drop("_shares")
    return match_fills(dealt, repeated, [*on, "_share"], **kwargs).drop("_share")


def with_matches(
    updates: DataFrame, stored: DataFrame, on: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Left join that brings ``columns`` of the stored row in as ``stored_*``."""
    lookup = stored.select(
        *on, *[F.col(c).alias(f"stored_{c}") for c in columns], F.lit(True).alias(MATCHED)
    )
    return updates.join(lookup, list(on), "left").withColumn(
        MATCHED, F.coalesce(MATCHED, F.lit(False))
    )


def enrich_otc_updates(
    updates: DataFrame, stored: DataFrame, on: Sequence[str] = ("order_id",)
) -> DataFrame:
    """OTC updates with absent fields taken from their stored request.

    Each of the four fields is filled independently; a zero amount counts as
    absent.
    """
    texts = ("biz_code", "proc_result", "prod_class")
    joined = with_matches(updates, stored, on, (*texts, "biz_amt"))
    filled: dict[str, Column] = {
        name: F.coalesce(E.present(name), F.col(f"stored_{name}"), F.col(name)) for name in texts
    }
    filled["biz_amt"] = F.coalesce(E.non_zero("biz_amt"), F.col("stored_biz_amt"), F.col("biz_amt"))
    return joined.withColumns(filled).drop(*[f"stored_{c}" for c in (*texts, "biz_amt")])


def enrich_request_updates(
    updates: DataFrame, stored: DataFrame, on: Sequence[str] = ("request_id",)
) -> DataFrame:
    """Branch-request updates with customer, branch and request date of their match."""
    columns = ("customer_id", "branch", "request_date")
    joined = with_matches(updates, stored, on, columns)
    return joined.withColumns({c: F.col(f"stored_{c}") for c in columns}).drop(
        *[f"stored_{c}" for c in columns]
    )


def enrich_order_updates(
    updates: DataFrame, stored: DataFrame, on: Sequence[str] = ("order_id",), outer: bool = False
) -> DataFrame:
    """Order updates with the details of their INSERT.

    ``outer=True`` is the older variant: an update without its order is kept,
    under channel ``qt`` and an empty customer and branch.
    """
    columns = ("customer_id", "branch", "currency", "qty", "price", "channel")
    lookup = stored.select(*on, *columns)
    joined = updates.select(*[c for c in updates.columns if c not in columns]).join(
        lookup, list(on), "left" if outer else "inner"
    )
    if not outer:
        return joined
    return joined.withColumns(
        {
            "customer_id": F.coalesce("customer_id", F.lit("")),
            "branch": F.coalesce("branch", F.lit("")),
            "currency": F.coalesce("currency", F.lit("")),
            "qty": F.coalesce("qty", F.lit(0)),
            "price": F.coalesce("price", F.lit(0).cast(S.MONEY)),
            "channel": F.coalesce("channel", F.lit(S.OTHER_CHANNEL)),
        }
    )


def attach_products(otc: DataFrame, products: DataFrame) -> DataFrame:
    """OTC requests with issuer and type of their product; unknown ones stay null."""
    return otc.withColumn("prod_id", F.trim("prod_id")).join(products, "prod_id", "left")


def matched_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys on both sides. Repeated keys collapse on each side before they meet."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), list(on), "left_semi")


def missing_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of the left side that the right side lacks."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), list(on), "left_anti")


def lookup_keys(
    fills: DataFrame, updates: DataFrame, inserts: DataFrame, on: Sequence[str]
) -> DataFrame:
    """Keys that must be looked up: wanted by a fill or update, not inserted now."""
    wanted = fills.select(*on).unionByName(updates.select(*on)).distinct()
    return wanted.join(inserts.select(*on).distinct(), list(on), "left_anti")


def without_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key the right side, one row per key, lacks."""
    return left.join(right.select(*on), list(on), "left_anti")
