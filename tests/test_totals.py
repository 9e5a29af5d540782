"""Totals that are merged partition by partition, and streams kept in Spark's state."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from messages import DAY, RULES, fill, order, raw, request
from pyspark.sql import functions as F

from tradepulse.operators import metrics as M
from tradepulse.operators import project as P
from tradepulse.operators.ingest import parse_envelopes
from tradepulse.session import work_folder
from tradepulse.sources.changes import read_change_files
from tradepulse.streaming import totals as R
from tradepulse.streaming.job import ActivityJob
from tradepulse.streaming.native import FILL_KEY, ORDER_KEY, fills_with_orders, into_totals, once_within, running_totals
from tradepulse.streaming.tables import StepTables, held

RATES = "SELECT * FROM VALUES ('USD', 7.0BD), ('RMB', 1.0BD) AS t(currency, rate)"


@pytest.fixture()
def make_job(spark):
    def build(**kwargs):
        products = spark.sql("SELECT * FROM VALUES ('77', '1000056', '511') AS t(prod_id, issuer, prod_type)")
        kwargs.setdefault("business_date", DAY)
        return ActivityJob(spark, work_folder(spark, "test") + "/job", spark.sql(RATES), products, RULES, **kwargs)

    return build


@pytest.fixture()
def totals(spark):
    return R.Totals(StepTables(spark, work_folder(spark, "totals")), parts=4)


def commit(totals, step):
    totals.tables.write(totals.tables.spark.range(1), "ledger", step)


def add(totals, rows, step, kind=R.ACTIVITY, replace=False, done=True):
    columns = "business_date int, branch string, metric string, n long, amount decimal(38,12)"
    changes = R.changes(kind, totals.tables.spark.createDataFrame(rows, columns))
    with held() as hold:
        touched = totals.add([changes], step, hold, replace)
    if done:
        commit(totals, step)
        totals.drop_older(touched, step)
    return touched


def seen(totals, kind=R.ACTIVITY):
    return {(r.business_date, r.branch, r.metric): (r.n, r.amount) for r in totals.rows(kind).collect()}


def size(folder):
    return sum(os.path.getsize(os.path.join(path, f)) for path, _, files in os.walk(folder.removeprefix("file:")) for f in files)


def test_changes_add_up_and_untouched_partitions_stay(totals):
    one = Decimal(1)
    add(totals, [(1, "a", "x", 1, one), (1, "b", "x", 2, None), (None, "a", "x", 1, one)], 0)
    before = {part: paths for part, paths in totals.versions().items()}
    touched = add(totals, [(1, "a", "x", 4, one), (1, None, None, 1, one)], 2)
    assert seen(totals) == {(1, "a", "x"): (5, 2), (1, "b", "x"): (2, None), (None, "a", "x"): (1, 1), (1, None, None): (1, 1)}
    after = totals.versions()
    assert all(len(paths) == 1 for paths in after.values())
    assert {p for p in before if after[p] != before[p]} == set(touched) & set(before)
    assert add(totals, [], 4) == [] and len(seen(totals)) == 4


def test_a_step_written_twice_counts_once_and_one_without_ledger_row_is_not_seen(totals):
    row = [(1, "a", "x", 1, Decimal(1))]
    add(totals, row, 0)
    add(totals, row, 2, done=False)
    assert seen(totals)[1, "a", "x"][0] == 1
    add(totals, row, 2)
    assert seen(totals)[1, "a", "x"][0] == 2
    add(totals, [(1, "a", "x", 9, None), (1, "q", "x", 9, None)], 4, done=False)
    totals.clear_after(2)
    assert seen(totals) == {(1, "a", "x"): (2, 2)}


def test_the_number_of_parts_of_a_table_is_fixed(spark, totals):
    add(totals, [(1, "a", "x", 1, None)], 0)
    with pytest.raises(ValueError, match="4 parts"):
        add(R.Totals(totals.tables, parts=5), [(1, "a", "x", 1, None)], 2)
    add(R.Totals(totals.tables, parts=4), [(1, "a", "x", 1, None)], 2)
    assert seen(totals)[1, "a", "x"][0] == 2


def test_whole_totals_replace_key_by_key(totals):
    add(totals, [(1, "a", "x", 1, None), (1, "b", "x", 2, None)], 0)
    for step in (2, 4):
        add(totals, [(1, "a", "x", 7, None)], step, replace=True)
    assert seen(totals) == {(1, "a", "x"): (7, None), (1, "b", "x"): (2, None)}


def test_a_step_reads_what_it_touches_however_long_the_history(totals):
    """Bytes of the partitions that a step reads stay level over two hundred steps and many days."""
    sizes = []
    original = totals._load
    totals._load = lambda paths: sizes.append(sum(map(size, paths))) or original(paths)
    for day in range(60):  # earlier days, never touched again
        (os.makedirs(f"{totals.root}/kind=activity/business_date={day}/part=0/step=0"))
    for step in range(0, 400, 2):
        if step < 20 or step >= 380:
            add(totals, [(100, b, "x", 1, None) for b in "abcdefgh"], step)
        else:
            commit(totals, step)
    assert len(sizes) == 19 and max(sizes) <= 1.1 * min(sizes)
    assert len(totals.versions([(R.ACTIVITY, 100, p) for p in range(4)])) <= 4
    assert {r.n for r in original([p[-1] for p in totals.versions([(R.ACTIVITY, 100, p) for p in range(4)]).values()]).collect()} == {20}


def test_customers_are_counted_again_only_where_a_batch_brings_some(spark, totals):
    def people(ids, step):
        rows = [(1, "b", "c", f"0001{n}") for n in ids]
        df = spark.createDataFrame(rows, "business_date int, branch string, channel string, customer_id string")
        with held() as hold:
            touched = totals.add([R.customer_changes(df, "order")], step, hold)
        commit(totals, step)
        totals.drop_older(touched, step)
        return touched

    def count():
        return totals.rows(R.COUNT).agg(F.sum("n")).first()[0]

    spread = [n * R.WORDS_TOGETHER * 64 for n in range(40)]
    assert len(people(spread + list(range(100)), 0)) > 1 and count() == 139
    before = totals.versions(kind=R.COUNT)
    touched = people([5, 6, 1000], 2)
    assert len(touched) == 1 and count() == 140
    after = totals.versions(kind=R.COUNT)
    assert [p for p in after if after[p] != before[p]] == [(R.COUNT, 1, touched[0][2])]


LARGEST = {"WTSL": "1000000", "WTJG": "99000000", "BZ": "USD"}


@pytest.mark.parametrize("batches", [1, 2])
def test_sums_of_very_large_orders_do_not_stop_a_batch(spark, make_job, batches):
    job = make_job()
    text = order(1, **LARGEST)[3]
    for batch in range(batches):
        n = 20_000 // batches
        rows = spark.range(n).select(
            F.lit("SECURITIES_TDRWT").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
            F.replace(F.lit(text), F.lit('"WTH": "1"' if '"WTH": "1"' in text else '"WTH":"1"'), F.concat(F.lit('"WTH":"'), (F.col("id") + batch * n + 1).cast("string"), F.lit('"'))).alias("value"),
        )
        job.process(rows, batch)
    row = job.trade_stats().first()
    assert (row["entr_tims"], row["entr_amt"]) == (20_000, Decimal(20_000) * 99 * 10**12 * 7)


def test_cash_and_fills_of_the_largest_amounts(spark):
    rows = spark.range(20_000).select(F.lit(DAY).alias("business_date"), F.lit("zjzr").alias("direction"), F.lit("USD").alias("currency"), F.lit("99999999999999.9999").cast("decimal(18,4)").alias("amount"))
    got = M.cash_flow(rows, spark.sql(RATES)).first()
    assert got["amount"] == Decimal("99999999999999.9999") * 7 * 20_000


def test_a_committed_batch_that_comes_again_is_published_and_not_added(make_job):
    job = make_job(publish=True)
    job.process(raw(job.spark, [order(1)]), 0)
    job.process(raw(job.spark, [order(2, 1)]), 1)
    job.totals.tables.delete(job.tables.path("results/trade"))
    again = ActivityJob(job.spark, job.root, job.rates, job.products, job.rules, business_date=DAY, publish=True)
    again.process(raw(job.spark, [order(2, 1)]), 1)
    assert [(r.entr_tims, r.date_id) for r in again.published("trade").collect()] == [(2, DAY)]


def test_state_expires_without_a_business_date(make_job):
    job = make_job(business_date=None, fold_every=2, keep_days=1)
    days = [20240112, 20240113, 20240114, 20240115, 20240116]
    for batch, day in enumerate(days):
        ahead = (dt.datetime.strptime(str(day), "%Y%m%d") - dt.datetime(2024, 1, 15)).days * 86_400
        job.process(raw(job.spark, [request(f"Q{day}", "INSERT", batch, day=day, seconds=ahead)]), batch)
    kept = {r.business_date for r in job.state("dept_request").collect()}
    assert kept == {20240115, 20240116}


def test_a_source_time_ahead_of_the_clock_expires_nothing(make_job):
    job = make_job(business_date=None)
    assert job._day(dt.datetime(2999, 1, 1), fold=True) < 29990101
    assert job._day(None, fold=True) is None


def timed(raw_stream, kind):
    return P.records(parse_envelopes(raw_stream, kinds=[kind]), kind, DAY, RULES).where("event_ts IS NOT NULL")


def land(spark, root, waves, build, mode, write):
    """Progress of every batch of a stream that is restarted for each wave."""
    found = []
    for wave in waves:
        raw(spark, wave).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        query = build(read_change_files(spark, f"{root}/landing")).writeStream.outputMode(mode).foreachBatch(write)
        query = query.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        found += query.recentProgress
    return found


def test_remembered_ids_stay_few_under_a_watermark(spark, totals):
    root = work_folder(spark, "once")
    waves = [[fill(n, str(n), n, seconds=600 * n), fill(n, str(n), n, seconds=600 * n), fill(n - 1, str(n - 1), n, seconds=600 * n)] for n in range(2, 13)]
    measure = lambda batch: M.fill_metrics(batch.withColumn("channel", F.lit("c")), spark.sql(RATES))
    progress = land(spark, root, waves, lambda r: once_within(timed(r, "fill"), FILL_KEY, "15 minutes"), "append", into_totals(totals, measure))
    assert totals.rows(R.TRADE).agg(F.sum("mtch_tims")).first()[0] == 12  # fills 1 to 12, each once
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(kept) <= 5


def test_fills_meet_orders_inside_the_bound_and_leave_outside_it(spark, totals):
    root = work_folder(spark, "bound")
    waves = [
        [fill(1, "1", 1, seconds=0), fill(2, "1", 2, seconds=0), fill(3, "1", 3, seconds=0), order(2, 4, seconds=30)],
        [order(1, 5, seconds=50), order(3, 6, seconds=300)],
        [order(9, 7, seconds=9000), fill(8, "1", 8, seconds=9000)],
    ]

    def build(r):
        fills, orders = once_within(timed(r, "fill"), FILL_KEY, "5 minutes"), once_within(timed(r, "order"), ORDER_KEY, "5 minutes")
        return fills_with_orders(fills, orders, "1 minute", "1 minute")

    land(spark, root, waves, build, "append", into_totals(totals, lambda batch: M.fill_metrics(batch, spark.sql(RATES))))
    assert {r.channel: r.mtch_tims for r in totals.rows(R.TRADE).collect()} == {"app": 2, "undefine": 1}


def test_state_on_disk_gives_the_same_and_holds_for_the_stream_alone(spark, totals):
    from tradepulse.streaming.native import STATE_ON_DISK, state_on_disk

    root = work_folder(spark, "disk")
    waves = [[fill(1, "1", 1), fill(1, "1", 2), fill(2, "1", 3)], [fill(1, "1", 4), order(1, 5, seconds=50)], [order(9, 7, seconds=9000), fill(8, "1", 8, seconds=9000)]]

    def build(r):
        fills, orders = once_within(timed(r, "fill"), FILL_KEY, "5 minutes"), once_within(timed(r, "order"), ORDER_KEY, "5 minutes")
        return fills_with_orders(fills, orders, "1 minute", "1 minute")

    before = {key: spark.conf.get(key, None) for key in STATE_ON_DISK}
    with state_on_disk(spark):
        land(spark, root, waves, build, "append", into_totals(totals, lambda batch: M.fill_metrics(batch, spark.sql(RATES))))
    assert {key: spark.conf.get(key, None) for key in STATE_ON_DISK} == before
    assert {r.channel: r.mtch_tims for r in totals.rows(R.TRADE).collect()} == {"app": 1, "undefine": 1}
    assert totals.tables.glob(f"{root}/checkpoint/state/*/*/*.zip") and not totals.tables.glob(f"{root}/checkpoint/state/*/*/*/*.delta")


def test_totals_in_state_go_on_after_a_restart_and_a_lost_ledger_row(spark, totals):
    root = work_folder(spark, "state")
    waves = [[order(1), order(2, 1)], [order(3, 2), order(4, 3, YYB="B09")]]
    build = lambda r: running_totals(M.order_rows(timed(r, "order")), spark.sql(RATES))
    land(spark, root, waves[:1], build, "update", into_totals(totals, lambda b: b, replace=True))
    land(spark, root, waves[1:], build, "update", into_totals(totals, lambda b: b, replace=True))
    want = {"B01": 3, "B09": 1}
    assert {r.branch: r.entr_tims for r in totals.rows(R.TRADE).collect()} == want
    totals.tables.clear("ledger", totals.tables.last_step())
    totals.tables.delete(f"{root}/checkpoint/commits/{len(waves) - 1}")
    land(spark, root, [[order(5, 4)]], build, "update", into_totals(totals, lambda b: b, replace=True))
    assert {r.branch: r.entr_tims for r in totals.rows(R.TRADE).collect()} == {"B01": 4, "B09": 1}
