from decimal import Decimal

import pytest
from messages import DAY, RULES, fill, message, order, otc, raw, request
from pyspark.sql import functions as F

from tradepulse.operators import metrics as M
from tradepulse.session import work_folder
from tradepulse.sources.changes import kafka_options, next_offsets, read_change_files
from tradepulse.streaming import totals as R
from tradepulse.streaming.job import ActivityJob
from tradepulse.streaming.late import RetryLimit


@pytest.fixture()
def make_job(spark):
    def build(**kwargs):
        rates = spark.sql("SELECT * FROM VALUES ('USD', 7.0BD), ('RMB', 1.0BD) AS t(currency, rate)")
        products = spark.sql("SELECT * FROM VALUES ('77', '1000056', '511'), ('78', '1000056', '509') AS t(prod_id, issuer, prod_type)")
        kwargs.setdefault("business_date", DAY)
        return ActivityJob(spark, work_folder(spark, "test") + "/job", rates, products, RULES, **kwargs)

    return build


def feed(job, *batches):
    for batch_id, rows in enumerate(batches):
        job.process(raw(job.spark, rows), batch_id)


def trade(job):
    return {
        (r["branch"], r["channel"]): (r["entr_tims"], r["mtch_tims"], r["mtch_amt"])
        for r in job.trade_stats().collect()
    }


def activity(job):
    rows = job.activity_rows().groupBy("branch", "metric").agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount")
    )
    return {(r["branch"], r["metric"]): (r["n"], r["amount"]) for r in rows.collect() if r["n"]}


def snapshot(job):
    customers = {tuple(r) for r in job.customer_stats().collect()}
    return trade(job), activity(job), customers, job.quarantined().count()


def idle(n):
    return order(1000 + n, offset=1000 + n, YYB="IDLE")


@pytest.mark.parametrize("late,limit,channel", [(1, 3, "app"), (2, 3, "app"), (3, 3, "app"), (4, 3, "undefine")])
def test_fill_waits_for_its_order_up_to_the_limit(make_job, late, limit, channel):
    job = make_job(fill_limit=RetryLimit(limit))
    batches = [[fill(5)]] + [[idle(i)] for i in range(1, late)] + [[order(5)]]
    feed(job, *batches)
    assert {k[1] for k in trade(job) if k[0] == "B02"} == {channel}


def test_default_limits():
    job = ActivityJob.__dataclass_fields__
    assert job["fill_limit"].default.attempts == 10
    assert job["otc_limit"].default.attempts == job["request_limit"].default.attempts == 20


def test_fill_is_counted_once_with_amounts(make_job):
    job = make_job()
    feed(job, [fill(5), fill(5), fill(5, "2", KHH="000100000043")], [order(5)], [order(5, offset=9, WTGY="OP2", WTFS="64")], [fill(5, "3", offset=20)])
    totals = trade(job)
    assert totals[("B02", "app")] == (0, 2, Decimal("147.000000000000"))
    # a later entry of the same order id replaces the stored one
    assert totals[("B02", "desk")] == (0, 1, Decimal("73.500000000000"))
    assert (totals[("B01", "app")][0], totals[("B01", "desk")][0]) == (1, 1)
    people = {(r["branch"], r["channel"]): r["mtch_cust_nums"] for r in job.customer_stats().collect()}
    assert people[("B02", "app")] == 2


def test_drain_counts_waiting_fills_once_and_is_final(make_job):
    job = make_job()
    feed(job, [fill(5), fill(6)], [order(6)])
    assert [r["order_id"] for r in job.waiting("fill").collect()] == ["5"]
    job.drain()
    job.drain()
    assert trade(job)[("B02", "undefine")][1] == 1
    assert trade(job)[("B02", "app")][1] == 1
    job.process(raw(job.spark, [order(5)]), 2)
    assert trade(job)[("B02", "undefine")][1] == 1
    assert ("B02", "app") in trade(job) and trade(job)[("B02", "app")][1] == 1


def test_age_limit_follows_source_time(make_job):
    job = make_job(fill_limit=RetryLimit(10, max_age_seconds=30))
    feed(job, [fill(5)], [order(8, seconds=20)], [order(9, offset=1, seconds=60)])
    assert trade(job)[("B02", "undefine")][1] == 1


MIXED = [
    [fill(1), order(2, offset=1), request("Q1", "UPDATE", 2), otc(8, "UPDATE", 3, YWDM="DROP", CLJG="DROP", CPFL="DROP", YWJE="0")],
    [order(1, offset=4), request("Q2", "INSERT", 5), fill(2, offset=6), ("SECURITIES_TDRWT", 0, 7, "{bad"), otc(9, "INSERT", 8, CLZT="0", YWDM="22", CPFL="5")],
    [request("Q1", "INSERT", 9, branch="B07", status="1"), otc(8, "INSERT", 10, YWDM="7", YWJE="40", CLZT="1"), message("customer", {"KHH": "000142", "KHRQ": str(DAY), "KHLB": "0"}, offset=11)],
]


def expected_mixed():
    return {
        ("B01", "deal"): 1, ("B07", "deal"): 1, ("", "crrc"): 1, ("", "ins"): 1, ("", "new_gr"): 1,
    }


def test_replaying_any_batch_changes_nothing(make_job):
    job = make_job()
    feed(job, *MIXED)
    before = snapshot(job)
    assert {k: v[0] for k, v in before[1].items()} == expected_mixed()
    job.process(raw(job.spark, MIXED[-1]), 2)
    assert snapshot(job) == before
    rerun = make_job()
    for batch_id in (0, 0, 1, 1, 2):
        rerun.process(raw(job.spark, MIXED[batch_id]), batch_id)
    assert snapshot(rerun) == before


def test_results_do_not_depend_on_batching_or_arrival_order(make_job):
    job, reverse, single = make_job(), make_job(), make_job()
    feed(job, *MIXED)
    feed(reverse, *MIXED[::-1])
    feed(single, [row for batch in MIXED for row in batch])
    assert snapshot(job) == snapshot(reverse) == snapshot(single)


def test_compaction_keeps_results_and_state(make_job):
    job = make_job()
    feed(job, *MIXED)
    before = snapshot(job)
    job.compact()
    job.compact()
    assert snapshot(job) == before
    assert job.tables.steps("quarantine") == []
    job.process(raw(job.spark, [fill(2, "9", offset=30), request("Q2", "UPDATE", 31)]), 3)
    assert trade(job)[("B02", "app")][1] == before[0][("B02", "app")][1] + 1
    assert activity(job)[("B01", "deal")][0] == 2
    job.compact()
    assert activity(job)[("B01", "deal")][0] == 2


def test_uncommitted_step_is_invisible(make_job):
    job = make_job()
    feed(job, [order(1)], [order(2)])
    totals = trade(job)
    job.totals.add([R.changes(R.TRADE, job.trade_rows())], 4, lambda df: df)
    assert trade(job) == totals
    job._clean = False
    job.process(raw(job.spark, [order(3)]), 2)
    assert trade(job)[("B01", "app")][0] == 3


def test_otc_update_takes_each_absent_field_from_its_request(make_job):
    job = make_job()
    inserts = [otc(i, "INSERT", i, YWDM="7", CLZT="1", YWJE="40") for i in range(1, 6)]
    updates = [
        otc(1, "UPDATE", 11, YWDM="DROP", YWJE="5"),
        otc(2, "UPDATE", 12, YWDM="7", CLJG="DROP", YWJE="5"),
        otc(3, "UPDATE", 13, YWDM="7", CPFL=None, YWJE="5"),
        otc(4, "UPDATE", 14, YWDM="7", YWJE="0.00"),
        otc(5, "UPDATE", 15, YWDM="7", CLZT="1", YWJE="5"),
    ]
    feed(job, inserts, updates)
    assert activity(job) == {("", "ins"): (4, Decimal("55.000000000000"))}


def test_unknown_product_and_insurance_codes(make_job):
    job = make_job()
    sale = {"YWDM": "22", "CLZT": "0", "CPFL": "5"}
    feed(job, [
        otc(1, "INSERT", 1, CPID="77", **sale), otc(2, "INSERT", 2, CPID="78", **sale),
        otc(3, "INSERT", 3, CPID="99", **sale), otc(4, "INSERT", 4, CPID="DROP", **sale),
        otc(5, "INSERT", 5, YWDM="001"), otc(6, "INSERT", 6, YWDM="1"), otc(7, "INSERT", 7, YWDM="1", CPFL="9"),
    ])
    assert {k[1]: v[0] for k, v in activity(job).items()} == {"crrc": 1, "not_crrc": 1, "ins": 1, "otc_acc": 2}


def test_request_updates(make_job):
    job = make_job(request_limit=RetryLimit(1))
    feed(
        job,
        [request("same", "INSERT", 1, status="1"), request("same", "UPDATE", 2), request("gone", "UPDATE", 3), request("old", "UPDATE", 4)],
        [request("old", "INSERT", 5, day=20240114)],
        [request("gone", "INSERT", 6, status="1")],
    )
    # same: matched in its batch; old: entered another day; gone: came after the limit
    assert activity(job) == {("B01", "deal"): (1, 0)}
    strict = make_job(strict_reference=True)
    feed(strict, [request("late", "UPDATE", 1)], [request("late", "INSERT", 2, status="1")])
    assert activity(strict) == {}


def test_stream_equals_batch_one_file_at_a_time(spark, make_job):
    rows = [row for batch in MIXED for row in batch]
    landing = work_folder(spark, "landing")
    raw(spark, rows).repartition(5, "offset").write.mode("append").parquet(landing)
    job, once = make_job(), make_job()
    job.run_available(read_change_files(spark, landing, max_files_per_trigger=1))
    job.run_available(read_change_files(spark, landing, max_files_per_trigger=1))
    feed(once, rows)
    assert snapshot(job) == snapshot(once)
    assert len(job.tables.steps("ledger")) > 1


def test_offsets_for_a_cold_start(make_job):
    job = make_job()
    feed(job, [order(1, offset=4), fill(1, offset=2)], [order(2, offset=7)])
    offsets = next_offsets(job.tables.ledger())
    assert offsets == {"SECURITIES_TDRWT": {"0": 8}, "SECURITIES_TSSCJ": {"0": 3}}
    options = kafka_options("host:1", ["a", "b", "a"], offsets)
    assert options["subscribe"] == "a,b" and '"0": 8' in options["startingOffsets"]
    assert kafka_options("host:1", ["a"])["startingOffsets"] == "earliest"


def test_daily_rows(make_job):
    job = make_job()
    feed(job, *MIXED)
    day = job.customer_day_stats().first()
    assert (day["date_id"], day["new_indv_nums"], day["otc_acc_nums"]) == (DAY, 1, 0)
    assert job.otc_day_stats().first()["ins_entr_tims"] == 1
    assert {r["yyb"] for r in job.branch_day_stats().collect()} == {"B01", "B07"}


def test_idle_day_leaves_no_customer_row(spark):
    rows = spark.sql("SELECT 20240115 AS business_date, '' AS branch, 'ins' AS metric, 1L AS n, CAST(1 AS DECIMAL(38,12)) AS amount")
    assert M.customer_day_stats(rows).count() == 0
    assert M.otc_day_stats(rows).count() == 1


def test_new_checkpoint_goes_on_from_the_totals(make_job):
    """Batches of another run get steps of their own, folded before or not."""
    for fold in (False, True):
        job = make_job()
        job.process(raw(job.spark, [order(1)]), 0, run="first")
        if fold:
            job.compact()
        again = ActivityJob(job.spark, job.root, job.rates, job.products, job.rules, business_date=DAY)
        again.process(raw(job.spark, [order(2, offset=1, YYB="B09")]), 0, run="second")
        again.process(raw(job.spark, [order(2, offset=1, YYB="B09")]), 0, run="second")
        again.process(raw(job.spark, [order(1)]), 0, run="first")
        assert {k[0]: v[0] for k, v in trade(again).items()} == {"B01": 1, "B09": 1}


def test_drain_that_fails_before_its_ledger_row_leaves_nothing(make_job, monkeypatch):
    job = make_job()
    feed(job, [fill(5)])
    with monkeypatch.context() as patch:
        patch.setattr(ActivityJob, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            job.drain()
    job.process(raw(job.spark, [order(5, offset=1)]), 1)
    assert {k[1]: v[1] for k, v in trade(job).items() if v[1]} == {"app": 1}


def test_offsets_after_a_drain_and_an_empty_batch(make_job):
    job = make_job()
    feed(job, [order(1, offset=4)], [])
    job.drain()
    assert next_offsets(job.tables.ledger()) == {"SECURITIES_TDRWT": {"0": 5}}


def test_a_value_out_of_range_is_set_aside_alone(make_job):
    job = make_job()
    feed(job, [order(1), order(2, 1, WTSL="2000000000", WTJG="99999999999999"), order(3, 2, WTJG="1.23456"), order(4, 3)])
    assert trade(job)[("B01", "app")][0] == 2
    assert {r["reject_reason"] for r in job.quarantined().collect()} == {"too_large", "too_precise"}


def test_records_that_gave_up_are_kept(make_job):
    job = make_job(otc_limit=RetryLimit(1), request_limit=RetryLimit(1))
    feed(job, [request("Q", "UPDATE", 1), otc(8, "UPDATE", 2, YWDM="DROP", CLJG="DROP")], [idle(1)], [idle(2)])
    assert [(r["request_id"], r["attempts"]) for r in job.expired("dept_request").collect()] == [("Q", 1)]
    assert [r["order_id"] for r in job.expired("otc").collect()] == ["8"]
    assert job.waiting("otc").count() == job.waiting("dept_request").count() == 0


def test_job_folds_and_expires_by_itself(make_job):
    job = make_job(fold_every=2, publish=True)
    feed(job, [request("Q1", "INSERT", 1)], [order(1)], [order(2, 1)], [fill(1)], [fill(2, "2", 3)])
    assert len(job.tables.steps("ledger")) <= 2 and job.tables.last_step() == 8
    assert {k: v[:2] for k, v in trade(job).items()} == {("B01", "app"): (2, 0), ("B02", "app"): (0, 2)}
    row = job.published("trade").where("dept = 'B02'").first()
    assert (row["mtch_tims"], row["mtch_cust_nums"], row["entr_cust_nums"]) == (2, 1, 0) and row["stat_time"]
    assert next_offsets(job.tables.ledger())["SECURITIES_TDRWT"] == {"0": 2}


def test_hot_order_is_split_through_the_job(spark, make_job):
    """Every batch holds the orders it looks up, so its join can be split."""
    job = make_job()
    feed(job, [order(7)], [fill(7, str(i), i) for i in range(50)])
    assert trade(job)[("B02", "app")][1] == 50


def test_timed_trigger(spark, make_job):
    landing = work_folder(spark, "timed")
    raw(spark, [order(1), order(2, 1)]).write.parquet(landing)
    job = make_job()
    query = job.start(read_change_files(spark, landing), interval="1 second")
    query.processAllAvailable()
    query.stop()
    assert trade(job)[("B01", "app")][0] == 2


def test_fills_once_across_batches_and_folds(make_job):
    job = make_job(fills_once=True)
    feed(job, [order(5), fill(5, "1", 1)], [fill(5, "1", 9), fill(5, "2", 10)])
    assert trade(job)[("B02", "app")][1] == 2
    job.compact()
    job.process(raw(job.spark, [fill(5, "2", 20), fill(5, "3", 21)]), 2)
    job.process(raw(job.spark, [fill(5, "2", 20), fill(5, "3", 21)]), 2)
    assert trade(job)[("B02", "app")][1] == 3


def test_folded_state_is_found_by_a_session_that_does_not_know_it(spark, make_job):
    job = make_job(business_date=None)
    feed(job, [order(5), request("Q", "INSERT", 1, status="1"), otc(8, "INSERT", 2, YWDM="7", YWJE="40", CLZT="1")])
    job.compact()
    for kind in ("order", "dept_request", "otc"):
        spark.sql(f"DROP TABLE {job._bucketed(kind, 0)[0]}")
    job.process(raw(spark, [fill(5, offset=9), request("Q", "UPDATE", 10), otc(8, "UPDATE", 11, YWDM="DROP")]), 1)
    assert trade(job)[("B02", "app")][1] == 1
    assert activity(job)[("B01", "deal")][0] == 1 and activity(job)[("", "ins")][0] == 1
    assert {r["order_id"] for r in job.state("order").collect()} == {"5"}
    job.process(raw(spark, [order(5, 12, YYB="B03"), order(6, 13)]), 2)
    job.compact()
    assert {(r["order_id"], r["branch"]) for r in job.state("order").collect()} == {("5", "B03"), ("6", "B01")}


def test_held_records_carry_no_text_of_usable_messages(make_job, monkeypatch):
    """What a batch keeps follows its typed fields, not its messages; unusable ones keep theirs."""
    import contextlib

    from tradepulse.streaming import job as module

    texts = []

    @contextlib.contextmanager
    def watched():
        with held() as hold:
            def keep(df):
                frame = hold(df)
                texts.extend(r["value"] for r in frame.select("value").collect()) if "value" in frame.columns else None
                assert "after" not in frame.columns
                return frame

            yield keep

    held = module.held
    monkeypatch.setattr(module, "held", watched)
    late = ("TRADE_MONITOR_SLOW", 0, 9, '{"originTopic":"SECURITIES_TSSCJ","baseRecord":{"khh":"cust7","wth":"5","cjbh":"9","cxbz":"O","bz":"usd","gdh":"g","cjje":"1"}}')
    bad = order(6, offset=2, WTSL="abc")
    job = make_job()
    feed(job, [order(5), fill(5, offset=1), bad, late])
    assert [t for t in texts if t is not None] == [bad[3]]
    assert [(r["reject_reason"], r["value"]) for r in job.quarantined().collect()] == [("bad_number", bad[3])]
    assert trade(job)[("B02", "app")][1] == 1


def test_large_steps_hold_their_records_in_files_and_give_the_same(make_job, monkeypatch):
    """Of more rows than ``file_rows`` nothing is held in memory, and the files are gone after the step."""
    from pyspark.sql import DataFrame

    late = ("TRADE_MONITOR_SLOW", 0, 9, '{"originTopic":"SECURITIES_TSSCJ","baseRecord":{"khh":"cust7","wth":"5","cjbh":"9","cxbz":"O","bz":"usd","gdh":"g","cjje":"1"}}')
    batches = [
        [order(5), fill(5, offset=1), fill(6, "2", 2), fill(6, "3", 3, CXBZ="W"), order(7, offset=4, WTSL="abc"), request("Q", "UPDATE", 5)],
        [late, order(6, 14), fill(5, offset=10), fill(7, "8", 11), request("Q", "INSERT", 12), fill(9, offset=13, CJJE="x")],
    ]
    found = []
    for rows in (1_000_000, 0):
        if not rows:
            monkeypatch.setattr(DataFrame, "persist", lambda *a: pytest.fail("held in memory"))
        job = make_job(fills_once=True, file_rows=rows)
        feed(job, *batches)
        waits = {tuple(r) for r in job.waiting("fill").select("order_id", "fill_id", "attempts").collect()}
        job.drain()
        found.append((*snapshot(job), waits, {r["order_id"] for r in job.state("order").collect()}))
        assert not job.tables.steps("kept")
    assert found[0] == found[1]


def test_messages_of_a_wave_go_once_they_are_committed(spark, sf_dir):
    from tradepulse.plans import streams

    job = streams.run_waves(spark, sf_dir, streams._order_waves(spark, sf_dir), name="gone")
    assert job.trade_stats().count() and not job.tables.glob(f"{job.root}/../landing/*")
