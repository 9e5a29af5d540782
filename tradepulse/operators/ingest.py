"""Raw change messages to parsed envelopes, and what must be set aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions.expressions import source_timestamp_sql

MALFORMED = "malformed_json"
UNKNOWN_TOPIC = "unknown_topic"
BAD_SOURCE_TIME = "bad_source_time"

# Where a message came from, and its text.
ORIGIN = ("topic", "partition", "offset", "value")
_PARSE_OPTIONS = {"columnNameOfCorruptRecord": "_corrupt_record"}


def drop_empty(raw: DataFrame, value: str = "value") -> DataFrame:
    """Keep messages that carry text."""
    return raw.where(F.length(value) > 0)


def _kind(topic: str, topics: Mapping[str, str]) -> str:
    cases = " ".join(f"WHEN '{name.upper()}' THEN '{kind}'" for name, kind in topics.items())
    return f"CASE upper({topic}) {cases} END"


def parse_envelopes(
    raw: DataFrame,
    topics: Mapping[str, str] = S.TOPICS,
    before: bool = False,
    kinds: Sequence[str] | None = None,
    fields: bool = True,
) -> DataFrame:
    """One row per non-empty message, with its fields as a narrow struct.

    ``kinds`` parses messages of those kinds alone, and of them only their own fields.
    Without ``fields`` the envelope is read and ``after`` is left out.

    Columns: topic, partition, offset, value, kind, op, row_id, event_ts, after,
    before (if asked for) and reject_reason, null when the message is usable.
    The text is parsed once: the generator keeps filters above it from
    repeating the parse.
    """
    parsed = F.from_json("value", S.envelope_ddl(before, kinds, fields), _PARSE_OPTIONS)
    rows = drop_empty(raw)
    if kinds is not None:
        own = [name.upper() for name, kind in topics.items() if kind in kinds]
        rows = rows.where(F.upper("topic").isin(own))
    rows = rows.select(*ORIGIN, F.inline(F.array(parsed)))
    if not fields:  # what stands before the fault of a broken message depends on the fields that are read
        whole = F.from_json("value", S.envelope_ddl(before, kinds), _PARSE_OPTIONS)
        broken = F.col("_corrupt_record").isNotNull()
        rows = rows.withColumns({c: F.when(broken, whole[c]).otherwise(F.col(c)) for c in ("optype", "rowid", "jstime")})
    kinds_of = rows.selectExpr(
        *ORIGIN,
        f"{_kind('topic', topics)} AS kind",
        "optype AS op",
        "rowid AS row_id",
        f"{source_timestamp_sql('jstime')} AS event_ts",
        *(["after"] if fields else []),
        *(["before"] if before else []),
        "_corrupt_record IS NOT NULL OR NOT startswith(ltrim(value), '{') AS malformed",
    )
    reason = f"""CASE WHEN kind IS NULL THEN '{UNKNOWN_TOPIC}'
        WHEN malformed THEN '{MALFORMED}'
        WHEN kind IN {S.TIMED_KINDS} AND event_ts IS NULL THEN '{BAD_SOURCE_TIME}' END"""
    return kinds_of.withColumn("reject_reason", F.expr(reason)).drop("malformed")


def route(parsed: DataFrame, kind: str) -> DataFrame:
    """Usable messages of one kind."""
    return parsed.where((F.col("kind") == kind) & F.col("reject_reason").isNull())


def route_counts(parsed: DataFrame) -> DataFrame:
    """Messages per kind and operation, unusable ones under their reason."""
    return parsed.groupBy("kind", "op", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


def unwrap_late(
    raw: DataFrame,
    late_topic: str,
    origins: Mapping[str, str] = S.LATE_ORIGINS,
    kinds: Sequence[str] | None = None,
) -> DataFrame:
    """Messages a former deployment re-queued, as parsed envelopes.

    The text is upper-cased whole, as the wrapper's writer expects. Fills come
    back as INSERTs, the two request kinds as UPDATEs; ``attempts`` is the retry
    count. Wrappers of another origin are rejected as an unknown topic. Of the records
    only the fields of ``kinds`` are read, left out those of all kinds that ``origins`` name.
    """
    if kinds is None:
        kinds = tuple(dict.fromkeys(origins.values()))
    text = F.upper("value")
    mine = drop_empty(raw).where(F.upper("topic") == late_topic.upper())
    parsed = F.from_json(text, S.late_ddl(kinds), _PARSE_OPTIONS)
    rows = mine.select(
        "topic", "partition", "offset", text.alias("value"), F.inline(F.array(parsed))
    )
    return rows.selectExpr(
        *ORIGIN,
        f"{_kind('ORIGINTOPIC', origins)} AS kind",
        "CAST(NULL AS TIMESTAMP) AS event_ts",
        "BASERECORD AS after",
        "try_cast(coalesce(BASERECORD.VERSION, '0') AS INT) AS attempts",
        "_corrupt_record IS NOT NULL AS malformed",
    ).selectExpr(
        *ORIGIN,
        "kind",
        f"CASE WHEN kind = 'fill' THEN '{S.INSERT}' ELSE '{S.UPDATE}' END AS op",
        "CASE WHEN kind <> 'fill' THEN 'late' END AS row_id",
        "event_ts",
        "after",
        f"""CASE WHEN malformed THEN '{MALFORMED}' WHEN kind IS NULL THEN '{UNKNOWN_TOPIC}'
            WHEN attempts IS NULL THEN 'bad_number' END AS reject_reason""",
        "attempts",
    )
