"""Sharding by Hilbert curve: runs of equal length, cut from the curve over metadata.

Several dimensions are quantised, rows are put in the order of their cells on the curve, and
the order is cut into shards whose row counts differ by one at most. Rows of a shard share
narrow ranges in every dimension, so file statistics prune by any of them.

A row's place is found without sorting all rows in one task: cells are counted, large cells
are split by a hash of the id, and only these counts are added up along the curve.

Defined results: a null value of a dimension sorts first; a null text has no bytes and a
checksum of 0; rows of a cell are ordered by a hash of their id, then id, size and checksum;
repeated rows get a place each; an empty table gives no row; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse.llm.common import ranges, running_start, written

#: Bits of each dimension; rows that one task puts in order.
BITS, RUN = 5, 500


def curve_index(cells: Sequence[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of cells given by their coordinates.

    Goes from the highest bit down; at each, the lower bits are reflected or swapped with
    the first axis, as the sub-cube's orientation asks. Then the bits are read crosswise as
    a Gray code.
    """
    x = [np.asarray(c, np.int64).copy() for c in cells]
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for axis in range(len(x)):
            reflect = (x[axis] & high) != 0
            swap = np.where(reflect, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(reflect, x[0] ^ low, x[0] ^ swap)
            x[axis] = x[axis] ^ swap if axis else x[0]
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    fix = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        fix ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ fix) >> bit) & 1)
    return index


def log_cell(value: Column, bits: int = BITS) -> Column:
    """Cell of a number of any size: about three cells for each factor of four."""
    cell = F.floor(1.5 * F.log2(1 + F.greatest(value.cast("double"), F.lit(0.0))))
    return F.least(F.coalesce(cell, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def rank_cells(df: DataFrame, column: str, into: str, bits: int = BITS) -> DataFrame:
    """Add the cell of a text column: the place of its value among the distinct values."""
    order = [F.col("_value").asc_nulls_first()]
    # grouped and not made distinct, as a null is a value too
    values = df.groupBy(F.col(column).alias("_value")).agg(F.lit(1).cast("long").alias("_one"))
    parted = ranges(values, order, "values")
    cell = F.floor(F.col("_place") * (1 << bits) / max(parted.count(), 1)).cast("int")
    cells = running_start(parted, [], "_part", order, "_one", "_place").select("_value", cell.alias(into))
    return df.join(cells, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def places(df: DataFrame, cells: Sequence[str], order: Sequence[str], id_col: str, bits: int = BITS, run: int = RUN) -> DataFrame:
    """``df`` with ``curve`` and ``place``: its number in the order of the curve, from 0."""

    @F.pandas_udf(T.LongType())
    def index(coordinates: pd.DataFrame) -> pd.Series:
        return pd.Series(curve_index([coordinates[c].to_numpy() for c in coordinates], bits))

    counted = df.groupBy(*cells).agg(F.count(F.lit(1)).alias("_rows")).withColumn("curve", index(F.struct(*cells)))
    rows = df.join(counted, list(cells)).withColumn("_one", F.lit(1).cast("long"))
    # by what orders them too, so that rows that share an id, or have none, are dealt out
    part = F.pmod(F.xxhash64(F.col(id_col), *order), F.ceil(F.col("_rows") / run))
    bucketed = rows.withColumn("_bucket", F.struct("curve", part.alias("part")))
    by = [F.xxhash64(F.col(id_col), F.lit(3)), *[F.col(c) for c in (id_col, *order)]]
    return running_start(bucketed, [], "_bucket", by, "_one", "place").drop("_bucket", "_one", "_rows")


def cut(placed: DataFrame, total: int, shards: int) -> DataFrame:
    """Add ``shard`` and ``slot``: runs of equal length, the first ones longer by one if need be."""
    base, more = divmod(total, shards)
    long_rows = more * (base + 1)
    early = F.col("place") < long_rows
    late = F.col("place") - long_rows
    shard = F.when(early, F.expr(f"place div {base + 1}")).otherwise(F.lit(more) + F.floor(late / max(base, 1)))
    slot = F.when(early, F.col("place") % (base + 1)).otherwise(late % max(base, 1))
    return placed.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")})


def sharded(
    df: DataFrame, shards: int = 24, numbers: Sequence[str] = ("n_chars",), texts: Sequence[str] = ("source", "lang"),
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``size``, ``text_crc32``, ``curve``, ``shard`` and ``slot`` of every row."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 8
    checksum = F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long")
    cells = [f"_cell{i}" for i in range(len(numbers) + len(texts))]
    rows = df.select(
        id_col, size.alias("size"), checksum.alias("text_crc32"),
        *[log_cell(F.col(c)).alias(cell) for c, cell in zip(numbers, cells, strict=False)],
        *[F.col(c).alias(f"_text{i}") for i, c in enumerate(texts)],
    )
    rows = written(rows, "metadata")
    for i in range(len(texts)):
        rows = rank_cells(rows, f"_text{i}", cells[len(numbers) + i]).drop(f"_text{i}")
    placed = places(rows, cells, ["size", "text_crc32"], id_col)
    return cut(placed, rows.count(), shards).select(id_col, "size", "text_crc32", "curve", "shard", "slot")
