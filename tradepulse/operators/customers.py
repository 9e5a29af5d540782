"""Exact distinct customers: mergeable bitmaps, and plain distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse.functions import expressions as E
from tradepulse.operators.metrics import TRADE_KEYS


def customer_bitmaps(
    df: DataFrame,
    by: Sequence[str] = TRADE_KEYS,
    customer_id: str = "customer_id",
    start: int = 5,
) -> DataFrame:
    """Bitmap of customer ordinals per ``by`` and bucket of 32,768 ordinals.

    Repeated customers collapse before the first shuffle. The remaining ordinals
    (a few bytes each) are brought together by bucket and only then turned into
    bitmaps, so no task ships mostly empty 4 KB bitmaps, and a busy group
    spreads over its buckets.
    """
    keys = [*by, "bucket"]
    ordinals = (
        df.select(*by, E.customer_ordinal(customer_id, start).alias("ordinal"))
        .where(F.col("ordinal").isNotNull())
        .distinct()
    )
    placed = ordinals.select(
        *by,
        F.bitmap_bucket_number("ordinal").alias("bucket"),
        F.bitmap_bit_position("ordinal").alias("position"),
    ).repartition(*keys)
    return placed.groupBy(*keys).agg(F.bitmap_construct_agg("position").alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str] = TRADE_KEYS) -> DataFrame:
    """One bitmap per key and bucket."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(
    bitmaps: DataFrame, by: Sequence[str] = TRADE_KEYS, out: str = "cust_nums"
) -> DataFrame:
    """Distinct customers per key from merged bitmaps."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(out))


#: Ordinals that one word of a set holds, a bit each.
WORD = 64


def word_rows(
    df: DataFrame,
    by: Sequence[str] = TRADE_KEYS,
    customer_id: str = "customer_id",
    start: int = 5,
) -> DataFrame:
    """The word and the bit of each row's customer; rows without an ordinal are left out."""
    bits = df.select(*by, E.customer_ordinal(customer_id, start).alias("ordinal")).where(F.col("ordinal").isNotNull())
    return bits.select(
        *by,
        F.shiftright("ordinal", WORD.bit_length() - 1).alias("word"),
        F.expr(f"shiftleft(1L, cast(ordinal % {WORD} AS INT))").alias("mask"),
    )


def customer_words(
    df: DataFrame,
    by: Sequence[str] = TRADE_KEYS,
    customer_id: str = "customer_id",
    start: int = 5,
) -> DataFrame:
    """Set of customer ordinals per ``by``, as the words that hold any: ``word``, ``mask``.

    A lone id costs its word and mask, a few bytes once stored; where ids are dense, one
    word holds 64. Words with the same number merge by a bitwise or, exactly, within
    tasks before any shuffle, and a busy group spreads over its words.
    """
    return merge_words(word_rows(df, by, customer_id, start), by)


def merge_words(words: DataFrame, by: Sequence[str] = TRADE_KEYS) -> DataFrame:
    """Union of sets, per key."""
    return words.groupBy(*by, "word").agg(F.bit_or("mask").alias("mask"))


def word_counts(words: DataFrame, by: Sequence[str] = TRADE_KEYS, out: str = "cust_nums") -> DataFrame:
    """Distinct customers per key; each word of a key must stand there once."""
    return words.groupBy(*by).agg(F.sum(F.bit_count("mask")).cast("bigint").alias(out))


def customer_counts(
    orders: DataFrame,
    fills: DataFrame,
    by: Sequence[str] = TRADE_KEYS,
    customer_id: str = "customer_id",
    start: int | None = 5,
) -> DataFrame:
    """Order and fill customers side by side, zeros where one side is missing.

    One union serves both counts. ``start=None`` counts whole ids instead of the
    number behind the prefix.
    """

    def ids(df: DataFrame, kind: str) -> DataFrame:
        who: Column = (
            F.col(customer_id) if start is None else E.customer_ordinal(customer_id, start)
        )
        return df.select(*by, F.lit(kind).alias("kind"), who.alias("who")).where(
            F.col("who").isNotNull()
        )

    seen = ids(orders, "order").unionByName(ids(fills, "fill")).distinct()
    return seen.groupBy(*by).agg(
        F.count(F.when(F.col("kind") == "order", 1)).alias("entr_cust_nums"),
        F.count(F.when(F.col("kind") == "fill", 1)).alias("mtch_cust_nums"),
    )
