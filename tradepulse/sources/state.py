"""Lookups in keyed state tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.operators.dedup import last_per_key


def lookup_state(
    state: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    newest: Sequence[Column],
) -> DataFrame:
    """Newest stored row of each wanted key.

    The semi join drops every other key before the rows are ranked, so the cost
    of the ranking follows the batch and not the state.
    """
    wanted = state.join(keys.select(*on).distinct(), list(on), "left_semi")
    return last_per_key(wanted, on, newest)


def write_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int, partition_by: Sequence[str] = ()) -> None:
    """Write keyed rows at ``path`` as a table bucketed by ``key``, one file for each bucket and partition."""
    writer = rows.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    rows.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def open_bucketed(
    spark: SparkSession, table: str, path: str, ddl: str, key: str, buckets: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """The table of :func:`write_bucketed`, made known to the session's catalog if it is not."""
    if not spark.catalog.tableExists(table):
        parted = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(
            f"CREATE TABLE {table} ({ddl}) USING parquet {parted} "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if partition_by:
            spark.catalog.recoverPartitions(table)
    return spark.table(table)


def lookup_bucketed(state: DataFrame, keys: DataFrame, key: str, also: Sequence[str] = ()) -> DataFrame:
    """Rows of a bucketed table whose ``key``, and ``also`` columns, are among ``keys``.

    The join is on ``key`` alone, by which the table is laid out, so its rows stay where
    they are and only the keys are shuffled, or broadcast if they are few.
    """
    wanted = keys.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in also]).distinct()
    # written as differences, these conditions are tested on joined rows and call for no layout
    same = [F.col(c) - F.col(f"_{c}") == 0 for c in also]
    return state.join(wanted, reduce(Column.__and__, same, F.col(key) == F.col("_key")), "left_semi")
