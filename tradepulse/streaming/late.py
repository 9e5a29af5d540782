"""Bounded late match: records that wait for a record they refer to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse.operators.dedup import last_per_key


@dataclass(frozen=True)
class RetryLimit:
    """How long an unmatched record is kept.

    ``attempts`` counts further batches after the first. ``max_age_seconds``
    also ends the wait once the stream's own source time has moved on that far;
    it uses no clock, so a replay decides alike.
    """

    attempts: int
    max_age_seconds: int | None = None


FILL_LIMIT = RetryLimit(10)
OTC_LIMIT = RetryLimit(20)
REQUEST_LIMIT = RetryLimit(20)


def candidates(
    fresh: DataFrame | None, pending: DataFrame | None, keys: Sequence[str]
) -> DataFrame | None:
    """New records and waiting ones, one per key; a newer record replaces a waiting one."""
    parts = []
    if fresh is not None:
        parts.append(
            fresh.withColumn("attempts", F.lit(0)).withColumn("first_seen", F.col("event_ts"))
        )
    if pending is not None:
        parts.append(pending)
    if not parts:
        return None
    if len(parts) == 1:
        return parts[0]
    both = parts[0].unionByName(parts[1])
    newest = [F.col("event_ts").desc_nulls_last(), F.col("src_offset").desc_nulls_last()]
    return last_per_key(both, keys, newest)


def gave_up(limit: RetryLimit, clock: Column | None = None) -> Column:
    """True once a still unmatched record has used its tries or its time."""
    over = F.col("attempts") >= limit.attempts
    if limit.max_age_seconds is not None and clock is not None:
        age = F.unix_timestamp(clock) - F.unix_timestamp("first_seen")
        over = over | F.coalesce(age > limit.max_age_seconds, F.lit(False))
    return over


def next_attempt(rows: DataFrame) -> DataFrame:
    """Waiting records as the next batch will read them."""
    return rows.withColumn("attempts", (F.col("attempts") + 1).cast("int"))
