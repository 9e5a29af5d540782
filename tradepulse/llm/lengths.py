"""Exact token length histogram.

Documents are aggregated by encoded length. With sums over the shorter and the longer
lengths, one row per length answers, for a context limit of that length, how many documents
and tokens fit, how many are cut, and how many tokens remain after cutting, and says which
percentiles of the documents have that length; limits between two lengths and other
quantiles follow from the same rows.

Lengths are added up in buckets of neighbours, and only sums of buckets meet in one window.

Defined results: null and empty texts have length 0 and are counted, and so are null
lengths; repeated rows count each; an empty table gives no row; extra columns are not looked
at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.llm.bpe import encode
from tradepulse.llm.common import written

#: Neighbouring lengths that a task adds up.
NEIGHBOURS = 1024


def encoded_lengths(df: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    ids = encode(df, rank_file, pattern, id_col, text_col)
    return ids.select(id_col, F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"))


def histogram(lengths: DataFrame, length_col: str = "n_tokens", neighbours: int = NEIGHBOURS) -> DataFrame:
    """One row per length, with sums over the lengths up to it and beyond it.

    ``percentiles`` lists the whole percentages p for which it is the smallest length that
    at least p per cent of the documents do not exceed.
    """
    length = F.coalesce(F.col(length_col), F.lit(0)).cast("long")
    counts = written(lengths.groupBy(length.alias("context_limit")).agg(F.count(F.lit(1)).alias("docs")), "lengths")
    rows = counts.withColumns(
        {"bucket": F.floor(F.col("context_limit") / neighbours), "tokens": F.col("docs") * F.col("context_limit")}
    )

    def around(df: DataFrame, window: Window, order: str, into: str) -> DataFrame:
        """Sums over all rows before and after each, in the order of ``order``."""
        ends = {
            "before": window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1),
            "after": window.orderBy(order).rowsBetween(1, Window.unboundedFollowing),
        }
        return df.withColumns(
            {f"{into}_{v}_{end}": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in ("docs", "tokens") for end, w in ends.items()}
        )

    sums = rows.groupBy("bucket").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    of_bucket = around(sums, Window.partitionBy(), "bucket", "outer").drop("docs", "tokens")
    both = around(rows, Window.partitionBy("bucket"), "context_limit", "inner").join(of_bucket, "bucket")
    total = lambda value, end: F.col(f"outer_{value}_{end}") + F.col(f"inner_{value}_{end}")
    summed = both.select(
        "context_limit",
        "docs",
        (total("docs", "before") + F.col("docs")).alias("docs_within"),
        (total("tokens", "before") + F.col("tokens")).alias("tokens_within"),
        total("docs", "after").alias("docs_cut"),
        total("tokens", "after").alias("tokens_beyond"),
    )
    first, last = (f"cast(100 * {docs} div (docs_within + docs_cut) as int)" for docs in ("(docs_within - docs)", "docs_within"))
    return summed.withColumns(
        {
            "tokens_kept": F.col("tokens_within") + F.col("docs_cut") * F.col("context_limit"),
            "tokens_total": F.col("tokens_within") + F.col("tokens_beyond"),
            "share_within": F.col("docs_within") / (F.col("docs_within") + F.col("docs_cut")),
            "percentiles": F.expr(f"case when {last} > {first} then sequence({first} + 1, {last}) else cast(array() as array<int>) end"),
        }
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Totals for any context limits, from the histogram alone."""
    asked = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("limit")
    length, docs = F.col("context_limit"), F.col("docs")
    return (
        hist.select("context_limit", "docs", asked)
        .groupBy("limit")
        .agg(
            F.sum(docs).alias("docs"),
            F.sum(F.when(length > F.col("limit"), docs).otherwise(0)).alias("docs_cut"),
            F.sum(docs * F.least(length, F.col("limit"))).alias("tokens_kept"),
            F.sum(docs * length).alias("tokens_total"),
        )
    )


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """Smallest length that at least the given share of the documents does not exceed."""
    asked = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    return (
        hist.select("context_limit", "share_within", asked)
        .filter(F.col("share_within") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("context_limit").alias("length"))
    )
