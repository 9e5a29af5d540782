"""Time headline queries: one warm-up, three timed runs into the noop sink, median.

Prints one JSON line, and each query's time to stderr as it is known.
``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (comma separated, ``all`` for
the whole catalogue, which takes over twenty minutes) override the defaults. Parsing is
also timed alone, over messages written beforehand; streams are timed once, as rows per
second and the median duration of a small warm batch.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tradepulse.operators import project as P  # noqa: E402
from tradepulse.operators.ingest import parse_envelopes  # noqa: E402
from tradepulse.plans import catalogue, cdc, tables  # noqa: E402
from tradepulse.schemas import RAW_SCHEMA  # noqa: E402
from tradepulse.session import build_session, work_folder  # noqa: E402
from tradepulse.streaming.job import ActivityJob  # noqa: E402

HEADLINE = (
    "orders_by_branch_channel", "fills_by_branch_channel", "trade_stat_daily",
    "customer_counts_merged", "order_customers_bitmap", "dedup_fills_last", "fills_unmatched",
    "lookup_keys", "state_lookup", "security_group_counts", "classify_channel_counts",
    "cash_flow_in_out", "new_customers_by_type", "dept_deals_by_branch", "otc_product_stats",
    "other_stat_daily", "cdc_project_orders", "cdc_project_fills", "cdc_route_counts",
    "order_customers_words", "classify_long_rules", "fills_matched_heavy", "state_lookup_bucketed",
)
STREAMS = ("stream_fills_late_match",)
BATCHES = 8


def run(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def parse_only(spark, sf_dir: str) -> dict[str, float]:
    """Seconds and messages per second to type fills that lie there as text."""
    path = f"{work_folder(spark, 'bench')}/fills"
    cdc.fill_messages(spark, sf_dir).write.parquet(path)
    raw = spark.read.parquet(path)
    timed = statistics.median(
        run(lambda s, _: P.records(parse_envelopes(raw, kinds=["fill"]), "fill", zone="UTC"), spark, sf_dir) for _ in range(3)
    )
    return {"parse_fills_alone": round(timed, 3), "parse_fills_per_second": round(raw.count() / timed)}


def small_batches(spark, sf_dir: str) -> dict[str, float]:
    """Median seconds of a micro-batch of two messages, without the first two."""
    root = f"{work_folder(spark, 'bench')}/job"
    job = ActivityJob(spark, root, tables.rates(spark), tables.products(spark, sf_dir), tables.DESK_RULES, 20240115)
    orders = cdc.order_messages(spark, sf_dir, op=F.lit("INSERT")).limit(2).select(*RAW_SCHEMA.names).collect()
    fills = cdc.fill_messages(spark, sf_dir, op=F.lit("INSERT"), unique=True).limit(2).select(*RAW_SCHEMA.names).collect()
    seconds = []
    for batch in range(BATCHES):
        raw = spark.createDataFrame([orders[batch % 2], fills[batch % 2]], RAW_SCHEMA)
        began = time.perf_counter()
        job.process(raw, batch)
        seconds.append(time.perf_counter() - began)
    return {"micro_batch_median": round(statistics.median(seconds[2:]), 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = catalogue.queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not chosen else list(queries) if chosen == "all" else chosen.split(",")
    spark = build_session(
        "tradepulse-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        run(queries[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run(queries[name], spark, sf_dir) for _ in range(3)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    more: dict[str, float] = {}
    if not chosen:
        for name in STREAMS:
            took = run(queries[name], spark, sf_dir)
            rows = sum(spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "lineitem"))
            seconds[name] = round(took, 3)
            more[f"{name}_rows_per_second"] = round(rows / took)
        more |= parse_only(spark, sf_dir) | small_batches(spark, sf_dir)
        print(more, file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf, "more": more}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
