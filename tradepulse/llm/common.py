"""What the operators share: tables, written intermediates, prefix sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.session import work_folder

#: Hash values are cut to this many steps where a share of the rows is taken.
STEPS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared work folder: cuts lineage, survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that a task holds few texts as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ranges(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``df`` as a table with ``_part``: numbers of the ranges of ``order`` it is dealt into.

    As the bucket of ``running_start`` they give sums along an order over all rows, and each
    task sorts one range.
    """
    return written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id().cast("long")), name)


def running_start(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column | str], value: str, into: str
) -> DataFrame:
    """Add ``into``: the sum of ``value`` over all earlier rows of the same group.

    Rows are ordered by ``bucket``, then ``order``. Sums per bucket are added up first and
    only they meet in one window, so no task sees a whole group: a bucket is what one task
    sorts. Group and bucket values may be null.
    """
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_before", F.coalesce(F.sum(value).over(within), F.lit(0)))
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = local.join(starts, match, "left")
    return joined.withColumn(into, F.col("_start") + F.col("_before")).drop(
        "_start", "_before", *[f"_k{i}" for i in range(len(keys))]
    )
