"""Hot values and long lists: what a task or a join sees stays bounded."""

import statistics

import pytest
from pyspark.sql import functions as F

from tradepulse.functions import rules as R
from tradepulse.operators import enrich as J
from tradepulse.session import work_folder
from tradepulse.sources.rules import rule_table
from tradepulse.sources.state import lookup_bucketed, open_bucketed, write_bucketed

FIELDS = ["mode", "operator", "branch"]
RULE_DDL = "class string, rule_id long, field string, n_fields int, allowed array<string>"


def by_hand(row, rules):
    """Class of the first rule whose every field allows the row's value."""
    for _, (name, asked) in sorted(rules.items()):
        if asked and all(f in row and row[f] in allowed for f, allowed in asked.items()):
            return name
    return "qt"


def as_table(spark, rules):
    rows = [(name, i, f, len(asked), allowed) for i, (name, asked) in rules.items() for f, allowed in asked.items()]
    return spark.createDataFrame(rows, RULE_DDL)


def test_rules_under_their_rarest_value_give_what_all_rules_give(spark):
    rules = {
        0: ("a", {"mode": ["1"], "operator": ["x", "y"]}),
        1: ("b", {"mode": ["1", "1", "2"]}),
        2: ("c", {"operator": ["x"], "branch": ["q"], "mode": ["1", "2", "3"]}),
        3: ("d", {"branch": ["q"], "elsewhere": ["x"]}),
        4: ("e", {"branch": []}),
        5: ("f", {"branch": ["q", None]}),
        6: ("g", {"mode": ["2", "1"]}),
        7: ("h", {"mode": ["3"], "branch": []}),
    }
    modes, operators, branches = ["1", "2", "3", "9", None], ["x", "y", None], ["q", "r", None]
    rows = [(m, o, b) for m in modes for o in operators for b in branches] * 2
    df = spark.createDataFrame(rows, "mode string, operator string, branch string")
    got = R.classify_by_table(df, as_table(spark, rules), FIELDS).collect()
    assert len(got) == len(rows)
    for r in got:
        own = {f: r[f] for f in FIELDS if r[f] is not None}
        # as before, a combination with a null meets no rule in the last join
        want = by_hand(own, rules) if len(own) == len(FIELDS) else "qt"
        assert r.channel == want, r


def test_rules_that_share_a_value_are_met_by_few_combinations(spark):
    n = 100_000
    own = F.array(
        F.struct(F.lit("mode").alias("field"), F.array(F.lit("1")).alias("allowed")),
        F.struct(F.lit("operator").alias("field"), F.array(F.col("id").cast("string")).alias("allowed")),
    )
    rules = spark.range(n).select(F.concat(F.lit("c"), F.col("id") % 7).alias("class"), F.col("id").alias("rule_id"), F.lit(2).alias("n_fields"), F.explode(own).alias("own")).select("class", "rule_id", "n_fields", "own.*")
    combos = spark.range(500).select(F.lit("1").alias("mode"), (F.col("id") * 400).cast("string").alias("operator"))
    index = R.rule_index(rules, ["mode", "operator"])
    assert R.rule_candidates(combos, index, ["mode", "operator"]).count() == 250
    got = {r.operator: r.channel for r in R.classify_by_table(combos, rules, ["mode", "operator"]).collect()}
    assert got == {str(i * 400): f"c{i * 400 % 7}" if i * 400 < n else "qt" for i in range(500)}


def test_rule_file_and_index_agree(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"p": [{"mode": ["1"], "operator": ["x"]}, {}], "q": [{"mode": ["1"]}], "r": [{"operator": ["x"]}]}')
    df = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "x"), ("2", "y")], "mode string, operator string")
    got = R.classify_by_table(df, rule_table(spark, str(path), "rules"), ["mode", "operator"]).collect()
    assert {(r.mode, r.operator): r.channel for r in got} == {("1", "x"): "p", ("1", "y"): "q", ("2", "x"): "r", ("2", "y"): "qt"}


@pytest.fixture()
def plain(spark):
    """Adaptive plans that broadcast tiny tables only and neither split nor join partitions."""
    keys = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "100KB",
        "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_half_of_all_fills_on_one_order_fill_no_task(plain):
    fills = plain.range(200_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7).cast("long")).otherwise(F.col("id")).alias("order_id"), F.col("id").alias("fill_id")
    )
    orders = plain.range(0, 200_000, 3).select(F.col("id").alias("order_id"), F.lit("c").alias("channel")).unionByName(
        plain.sql("SELECT 7L AS order_id, 'hot' AS channel")
    )
    matched = J.match_heavy_fills(fills, orders, heavy=2_000)
    hot = J.match_fills(fills, orders).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    assert hot.agg(F.max("n")).first()[0] > 100_000  # all of them in one task otherwise
    sizes = [r.n for r in matched.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 3 * statistics.median(sizes)
    got = {r.channel: r.n for r in matched.groupBy("channel").agg(F.count(F.lit(1)).alias("n")).collect()}
    odd = [i for i in range(1, 200_000, 2)]
    assert got == {"hot": 100_000 + 1, "c": sum(i % 3 == 0 for i in odd), "undefine": sum(i % 3 != 0 for i in odd) - 1}
    assert matched.columns == J.match_fills(fills, orders).columns


def test_fills_are_not_brought_together_by_a_heavy_order(plain):
    """Not even while nothing is known of how many heavy orders there are."""
    plain.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    fills = plain.range(1_000).select((F.col("id") % 3).alias("order_id"), F.col("id").alias("fill_id"))
    orders = plain.range(3).select(F.col("id").alias("order_id"), F.lit("c").alias("channel"))
    matched = J.match_heavy_fills(fills, orders, heavy=100)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1, plan
    assert matched.where("channel = 'c' AND matched").count() == 1_000


def test_without_heavy_orders_nothing_changes(spark):
    fills = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a")], "order_id long, fill_id string")
    orders = spark.createDataFrame([(1, "web"), (None, "no")], "order_id long, channel string")
    for heavy in (1, 100):
        got = sorted(map(tuple, J.match_heavy_fills(fills, orders, heavy=heavy).collect()), key=str)
        assert got == sorted(map(tuple, J.match_fills(fills, orders).collect()), key=str)


def test_bucketed_state_is_not_shuffled(spark):
    """Only the wanted keys are, also by another session that has to learn of the table."""
    path = work_folder(spark, "bucketed")
    rows = spark.range(20_000).select((F.col("id") % 2 + 1).cast("int").alias("day"), F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
    write_bucketed(rows, "bucketed_state", path, "k", 4, ["day"])
    keys = spark.createDataFrame([(1, "2"), (1, "4"), (2, "4"), (2, "7"), (2, "no"), (None, "8")] * 2, "day int, k string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for known in (True, False):
            if not known:
                spark.sql("DROP TABLE bucketed_state")
            state = open_bucketed(spark, "bucketed_state", path, "k string, v string, day int", "k", 4, ["day"])
            found = lookup_bucketed(state, keys, "k", ["day"])
            assert sorted((r.day, r.k) for r in found.collect()) == [(1, "2"), (1, "4"), (2, "7")]
            plan = found._jdf.queryExecution().executedPlan().toString()
            own = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")]
            left = own[: own.index("_key")] if "_key" in own else own
            scan = own[: own.index("bucketed_state")]
            assert "SortMergeJoin" in own and "SelectedBucketsCount: 4 out of 4" in own
            assert "Exchange" not in scan and own.count("Exchange") == 2, left  # distinct keys, then by key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS bucketed_state")
