"""What the plans look like, and that hot keys do not end in one task."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tradepulse.operators import customers as C
from tradepulse.operators import dedup as D
from tradepulse.operators import enrich as J
from tradepulse.operators.ingest import parse_envelopes
from tradepulse.operators.project import records
from tradepulse.plans import catalogue
from tradepulse.schemas import RAW_SCHEMA
from tradepulse.sources.changes import spread

BATCH = sorted(n for n in catalogue.queries() if not n.startswith("stream_"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


@contextlib.contextmanager
def conf(spark, **settings):
    old = {}
    for key, value in settings.items():
        name = key.replace("__", ".")
        old[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_forced_broadcast(spark, sf_dir, name):
    plan = plan_of(catalogue.queries()[name](spark, sf_dir))
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin", "strategy=broadcast"):
        assert node not in plan, node


def test_large_sides_are_shuffled_not_broadcast(spark, sf_dir):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(catalogue.queries()["fills_by_branch_channel"](spark, sf_dir))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(catalogue.queries()["fills_unmatched"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int>" in plan
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))" in plan


def test_topic_filter_runs_before_the_parse(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("t", 0, 1, "{}")], RAW_SCHEMA).write.parquet(path)
    plan = plan_of(records(parse_envelopes(spark.read.parquet(path)), "fill", 20240115))
    physical = plan[plan.index("== Physical Plan ==") :]
    _, below = physical.rsplit("Generate inline", 1)
    assert "SECURITIES_TSSCJ" in below[below.index("Filter") :]
    # one generator parses, one types: neither is repeated by what filters on it
    assert physical.count("from_json(") == 1 and physical.count("Generate inline") == 2


def test_scan_is_dealt_out_only_on_request(spark, sf_dir):
    scan = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert spread(scan) is scan
    assert spread(scan, 6).rdd.getNumPartitions() == 6
    many = spark.range(0, 1000, 1, 50)
    assert spread(many, 6) is many


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """60,000 fills, a third of them of order 7; 20,000 orders."""
    folder = tmp_path_factory.mktemp("skew")
    ids = spark.range(0, 60000, 1, 8)
    fills = ids.select(
        F.when(F.col("id") < 20000, 7).otherwise(F.col("id") % 20000).alias("order_id"),
        F.col("id").alias("fill_id"),
        F.when(F.col("id") < 20000, "0001000007").otherwise(F.format_string("0001%06d", F.col("id"))).alias("customer_id"),
        F.lit("x" * 60).alias("pad"),
    )
    fills.write.parquet(f"{folder}/fills")
    spark.range(0, 20000, 2).select(F.col("id").alias("order_id"), F.lit("app").alias("channel")).write.parquet(f"{folder}/orders")
    return spark.read.parquet(f"{folder}/fills"), spark.read.parquet(f"{folder}/orders")


def test_hot_order_is_split_in_the_fill_join(spark, skewed):
    fills, orders = skewed
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__shuffle__partitions="16",
    ):
        joined = J.match_fills(fills, orders)
        counts = {r["channel"]: r["n"] for r in joined.groupBy("channel").agg(F.count("pad").alias("n")).collect()}
        joined.persist().count()
        assert "skew=true" in plan_of(joined)
        joined.unpersist()
    even = sum(1 for i in range(20000, 60000) if (i % 20000) % 2 == 0)
    assert counts == {"app": even, "undefine": 60000 - even}


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, skewed):
    fills, _ = skewed
    last = D.last_per_key(fills, ["order_id"], [F.col("fill_id").desc()])
    plan = plan_of(last)
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Partial" in physical[physical.index("WindowGroupLimit") :] and physical.count("WindowGroupLimit") >= 2
    rows = {r["order_id"]: r["fill_id"] for r in last.collect()}
    assert rows[7] == 40007 and len(rows) == 20000


def test_bitmaps_equal_distinct_counts_across_buckets(spark, skewed):
    fills, _ = skewed
    frame = fills.withColumn("branch", F.when(F.col("order_id") == 7, "hot").otherwise("cold"))
    bits = C.customer_bitmaps(frame, ["branch"])
    assert bits.where("branch = 'cold'").count() == 2
    twice = C.merge_bitmaps(bits.unionByName(bits), ["branch"])
    got = {r["branch"]: r["cust_nums"] for r in C.bitmap_counts(twice, ["branch"]).collect()}
    want = {r["branch"]: r["n"] for r in frame.groupBy("branch").agg(F.countDistinct("customer_id").alias("n")).collect()}
    assert got == want
    merged = C.customer_counts(frame, frame.where("branch = 'hot'"), ["branch"])
    got = {r["branch"]: (r["entr_cust_nums"], r["mtch_cust_nums"]) for r in merged.collect()}
    assert got == {"cold": (want["cold"], 0), "hot": (want["hot"], want["hot"])}
    whole = C.customer_counts(frame, frame, ["branch"], start=None)
    assert {r["branch"]: r["entr_cust_nums"] for r in whole.collect()} == want


def test_daily_trade_table_takes_three_wide_exchanges(spark, sf_dir):
    """Two for the match of fills and orders, one for the totals; dimensions are broadcast or counted apart."""
    plan = plan_of(catalogue.queries()["trade_stat_daily"](spark, sf_dir))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") <= 3
