"""Streams whose memory is Spark's own state: bounded by a watermark, restarted from a checkpoint.

They stand beside the counted tries of :mod:`tradepulse.streaming.job`. Where lateness has a
bound in source time, nothing has to be kept in tables: ids are remembered, fills wait for
their order and totals are carried on in the state store, which drops what the watermark has
passed. Records need a source time; set those without one aside (``event_ts IS NULL``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.operators import metrics as M
from tradepulse.operators.enrich import MATCHED
from tradepulse.session import settings
from tradepulse.streaming import totals as R
from tradepulse.streaming.tables import StepTables, held

FILL_KEY = ("business_date", "order_id", "fill_id")
ORDER_KEY = ("business_date", "order_id")

_STORE = "spark.sql.streaming.stateStore"
#: State in RocksDB: it lies on disk, behind caches and write buffers of a bounded size for each
#: executor, where the default store has all keys in the heap. Of a batch only its changes are kept.
STATE_ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "500",
    f"{_STORE}.rocksdb.writeBufferSizeMB": "16",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def state_on_disk(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started within the block keep their state in RocksDB."""
    return settings(spark, STATE_ON_DISK)


def once_within(records: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """The first record of each key among those at most ``delay`` apart in source time.

    A key is forgotten once the watermark has passed it, so the state follows the rate of
    records and not their number.
    """
    return records.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(list(keys))


def fills_with_orders(
    fills: DataFrame, orders: DataFrame, earliest: str, latest: str, keys: Sequence[str] = ORDER_KEY
) -> DataFrame:
    """Each fill with its order's channel, whichever comes first, if their source times are near.

    An order may be entered from ``earliest`` before to ``latest`` after its fill. A fill that
    no order can reach any more leaves under the default channel. Both sides carry a watermark
    on ``event_ts``; orders have one row per key.
    """
    lookup = orders.select(*[F.col(k).alias(f"_{k}") for k in keys], "channel", F.col("event_ts").alias("_entered"))
    near = F.col("_entered").between(F.expr(f"event_ts - INTERVAL {earliest}"), F.expr(f"event_ts + INTERVAL {latest}"))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    joined = fills.drop("channel").join(lookup, [*same, near], "left_outer")
    channel = F.coalesce("channel", F.lit(S.UNMATCHED_CHANNEL))
    return joined.withColumns({"channel": channel, MATCHED: F.col("_entered").isNotNull()}).drop("_entered", *[f"_{k}" for k in keys])


def running_totals(rows: DataFrame, rates: DataFrame, by: Sequence[str] = M.TRADE_KEYS) -> DataFrame:
    """Totals of :func:`tradepulse.operators.metrics.order_rows` so far, kept in the state store.

    In update mode a batch yields the keys it changes, with their whole totals: writing
    them again changes nothing.
    """
    missing: Mapping[str, Column] = {m: F.lit(None).cast(t) for m, t in M.TRADE_MEASURES.items() if m not in rows.columns}
    return M.trade_totals_by_row(rows.withColumns(missing), rates, by)


def into_totals(totals: R.Totals, measure: Callable[[DataFrame], DataFrame], replace: bool = False) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges what ``measure`` makes of a batch into ``totals``.

    With ``replace`` the rows are whole totals and take the place of what is there. A batch
    that has its ledger row is skipped, one that failed before it is done again.
    """
    tables: StepTables = totals.tables

    def write(batch: DataFrame, batch_id: int) -> None:
        last = tables.last_step()
        if last is not None and batch_id <= last:
            return
        totals.clear_after(last)
        with held() as hold:
            touched = totals.add([R.changes(R.TRADE, measure(batch))], batch_id, hold, replace)
        done = tables.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"), F.current_timestamp().alias("committed_at"))
        tables.write(done.coalesce(1), "ledger", batch_id)
        totals.drop_older(touched, batch_id)

    return write
