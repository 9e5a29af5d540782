"""Catalogue: the streaming job over messages derived from the tables.

Each query lands its messages as files in waves, restarting the stream from its
checkpoint after every wave, so that records arrive before what they refer to.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.operators import metrics as M
from tradepulse.operators import project as P
from tradepulse.operators.ingest import parse_envelopes
from tradepulse.plans import activity as A
from tradepulse.plans import cdc
from tradepulse.plans import tables as T
from tradepulse.session import SHUFFLES_END, settings, work_folder
from tradepulse.sources.changes import read_change_files
from tradepulse.streaming.job import ActivityJob
from tradepulse.streaming.native import FILL_KEY, ORDER_KEY, fills_with_orders, into_totals, once_within, running_totals, state_on_disk
from tradepulse.streaming.tables import StepTables
from tradepulse.streaming.totals import TRADE, Totals

Query = Callable[[SparkSession, str], DataFrame]

DAY = 20240115
RETAINED_FROM = 20240110


def _land(spark: SparkSession, wave: DataFrame, path: str) -> None:
    """Append a wave's messages, whose texts are much alike and take little room compressed."""
    with settings(spark, SHUFFLES_END):
        wave.write.mode("append").option("compression", "zstd").parquet(path)


def run_waves(
    spark: SparkSession,
    sf: str,
    waves: Sequence[DataFrame],
    business_date: int | None = DAY,
    name: str = "stream",
    drain: bool = False,
    **options,
) -> ActivityJob:
    """Land each wave, then run the job over it from its checkpoint; what it has committed is taken away."""
    root = work_folder(spark, name)
    job = ActivityJob(
        spark, f"{root}/job", T.rates(spark), T.products(spark, sf), T.DESK_RULES, business_date, **options
    )
    for wave in waves:
        _land(spark, wave, f"{root}/landing")
        job.run_available(read_change_files(spark, f"{root}/landing"))
        job.tables.delete(f"{root}/landing")
    if drain:
        job.drain()
    return job


def _is_early() -> Column:
    return F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")


def _orders(spark: SparkSession, sf: str, keep: Column) -> DataFrame:
    return cdc.order_messages(spark, sf, op=F.lit("INSERT"), keep=keep)


def _fills(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.fill_messages(spark, sf, op=F.lit("INSERT"), unique=True)


def stream_cdc_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed messages appended by a checkpointed stream that is restarted once."""
    root = work_folder(spark, "ingest")
    first = cdc.order_messages(spark, sf).unionByName(cdc.fill_messages(spark, sf))
    second = T.event_messages(spark, sf, *cdc.EVENT_KINDS)
    for wave in (first, second):
        wave.write.mode("append").parquet(f"{root}/landing")
        parsed = parse_envelopes(read_change_files(spark, f"{root}/landing"), fields=False)
        kept = parsed.select("kind", "op", "topic", "partition", "offset", "reject_reason")
        query = (
            kept.writeStream.format("parquet")
            .option("path", f"{root}/parsed")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{root}/parsed").groupBy("kind", "op").agg(
        F.count(F.lit(1)).alias("n")
    )


def _order_waves(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [_orders(spark, sf, _is_early()), _orders(spark, sf, ~_is_early())]


def stream_orders_running_total(spark: SparkSession, sf: str) -> DataFrame:
    job = run_waves(spark, sf, _order_waves(spark, sf), name="orders")
    return job.trade_stats().select(
        "business_date", "branch", "channel", "entr_tims", "entr_amt", "marg_entr_tims", "stoc_entr_tims"
    )


def stream_distinct_customers(spark: SparkSession, sf: str) -> DataFrame:
    job = run_waves(spark, sf, _order_waves(spark, sf), name="customers")
    return job.customer_stats().select("branch", "channel", "entr_cust_nums")


def stream_cold_start(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, each from a checkpoint of its own, into one result folder; folded between."""
    root = work_folder(spark, "cold")
    for run, wave in enumerate(_order_waves(spark, sf)):
        wave.write.parquet(f"{root}/landing-{run}")
        job = ActivityJob(
            spark, f"{root}/job", T.rates(spark), T.products(spark, sf), T.DESK_RULES, DAY,
            checkpoint=f"{root}/checkpoint-{run}",
        )
        job.run_available(read_change_files(spark, f"{root}/landing-{run}"))
        if not run:
            job.compact()
    return job.trade_stats().select(
        "business_date", "branch", "channel", "entr_tims", "entr_amt", "marg_entr_tims", "stoc_entr_tims"
    )


def _match_waves(spark: SparkSession, sf: str) -> list[DataFrame]:
    """All fills and the early orders, then the late orders; pending ones never."""
    arrived = F.col("o_orderstatus") != "P"
    first = _fills(spark, sf).unionByName(_orders(spark, sf, arrived & _is_early()))
    return [first, _orders(spark, sf, arrived & ~_is_early())]


def stream_fills_late_match(spark: SparkSession, sf: str) -> DataFrame:
    job = run_waves(spark, sf, _match_waves(spark, sf), name="fills", drain=True)
    stats = job.trade_stats().where("mtch_tims <> 0")
    return stats.select("branch", "channel", "mtch_tims", "mtch_amt", "tot_cms")


def stream_fills_once(spark: SparkSession, sf: str) -> DataFrame:
    """Every fill is delivered again with the second wave, and counts once."""
    first, second = _match_waves(spark, sf)
    waves = [first, second.unionByName(_fills(spark, sf))]
    job = run_waves(spark, sf, waves, name="once", drain=True, fills_once=True)
    stats = job.trade_stats().where("mtch_tims <> 0")
    return stats.select("branch", "channel", "mtch_tims", "mtch_amt", "tot_cms")


def stream_pending(spark: SparkSession, sf: str) -> DataFrame:
    job = run_waves(spark, sf, _match_waves(spark, sf), name="pending")
    return job.waiting("fill").select("order_id", "fill_id", "attempts")


def stream_trade_stat(spark: SparkSession, sf: str) -> DataFrame:
    """The published trade table: totals and distinct customers on one row."""
    job = run_waves(spark, sf, _match_waves(spark, sf), name="published", drain=True, publish=True)
    return job.published("trade").select(
        "date_id", "dept", "trd_chn", "entr_tims", "entr_amt", "entr_cust_nums", "mtch_tims", "mtch_amt", "tot_cms", "mtch_cust_nums"
    )


def _wrapped_fills(spark: SparkSession, sf: str) -> DataFrame:
    """The same fills as a former deployment re-queued them, after three tries."""
    record = F.regexp_replace(F.get_json_object("value", "$.after"), r"\}$", ',"VERSION":3}')
    value = F.concat(F.lit('{"ORIGINTOPIC":"SECURITIES_TSSCJ","BASERECORD":'), record, F.lit("}"))
    return _fills(spark, sf).withColumns({"topic": F.lit(S.LATE_TOPIC), "value": value})


def _late_job(spark: SparkSession, sf: str, name: str, drain: bool) -> ActivityJob:
    arrived = F.col("o_orderstatus") != "P"
    return run_waves(spark, sf, [_wrapped_fills(spark, sf), _orders(spark, sf, arrived)], name=name, drain=drain)


def stream_late_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Wrapped fills count as the fills themselves do."""
    stats = _late_job(spark, sf, "late", True).trade_stats().where("mtch_tims <> 0")
    return stats.select("branch", "channel", "mtch_tims", "mtch_amt", "tot_cms")


def stream_late_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Wrapped fills that still wait, with their tries counted on."""
    return _late_job(spark, sf, "late-pending", False).waiting("fill").select("order_id", "fill_id", "attempts")


def stream_batch_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger rows after two batches and a replay of the second."""
    second = _fills(spark, sf)
    job = run_waves(spark, sf, [_orders(spark, sf, F.lit(True)), second], name="ledger")
    job.process(second, 1)
    return job.tables.ledger().select("topic", "step", "n")


def _by_op(spark: SparkSession, sf: str, kind: str) -> list[DataFrame]:
    """Updates first, everything else after."""
    messages = T.event_messages(spark, sf, kind)
    is_update = F.col("value").contains('"optype":"UPDATE"')
    return [messages.where(is_update), messages.where(~is_update)]


def stream_otc_late_match(spark: SparkSession, sf: str) -> DataFrame:
    job = run_waves(spark, sf, _by_op(spark, sf, "otc"), None, "otc", drain=True)
    rows = job.activity_rows().groupBy("business_date", "metric")
    return rows.agg(
        F.sum("n").alias("n"), F.sum("amount").cast("decimal(38,12)").alias("amount")
    )


def stream_otc_stat(spark: SparkSession, sf: str) -> DataFrame:
    """The published OTC table."""
    job = run_waves(spark, sf, _by_op(spark, sf, "otc"), None, "otc-stat", drain=True, publish=True)
    return job.published("otc").drop("stat_time")


def stream_dept_late_match(spark: SparkSession, sf: str) -> DataFrame:
    job = run_waves(spark, sf, _by_op(spark, sf, "dept_request"), None, "dept", drain=True)
    return job.branch_day_stats()


def stream_state_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Stored branch requests after older days are dropped and steps compacted."""
    job = run_waves(spark, sf, _by_op(spark, sf, "dept_request"), None, "retention")
    job.compact()
    job.expire(RETAINED_FROM)
    return job.state("dept_request").select("business_date", "request_id", "branch", "proc_status")


def stream_activity_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Customer, cash and account messages in two waves, as the daily row."""
    kinds = ("customer", "cash", "stock_account", "bank_account", "fund_account")
    waves = [T.event_messages(spark, sf, *part) for part in (kinds[:2], kinds[2:])]
    return run_waves(spark, sf, waves, None, "activity").customer_day_stats()


# Streams kept in Spark's state: keys stand for seconds of source time. Every wave brings the
# messages of one stretch of keys, late orders come a wave after their fills.
STRETCHES = 3


def _second(key: str) -> Column:
    start = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return F.expr(f"make_dt_interval(0, 0, 0, {key})") + start


def _stretch(spark: SparkSession, sf: str) -> int:
    """Keys of one stretch."""
    return T.load(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0] // STRETCHES + 1


def _timed_waves(spark: SparkSession, sf: str, width: int, twice: bool) -> list[DataFrame]:
    """Fills of each stretch, and again with the next one if asked for; orders in it or a wave late."""
    insert = F.lit("INSERT")
    arrived = F.col("o_orderstatus") != "P"
    waves = []
    for n in range(STRETCHES + 1):
        order_stretch, fill_stretch = (F.floor(F.col(key) / width) for key in ("o_orderkey", "l_orderkey"))
        due = ((order_stretch == n) & _is_early()) | ((order_stretch == n - 1) & ~_is_early())
        again = fill_stretch.isin(n, n - 1) if twice else fill_stretch == n
        orders = cdc.order_messages(spark, sf, op=insert, keep=arrived & due, ts=_second("o_orderkey"))
        fills = cdc.fill_messages(spark, sf, op=insert, unique=True, keep=again, ts=_second("l_orderkey"))
        waves.append(orders.unionByName(fills))
    return waves


def _later(spark: SparkSession, seconds: int) -> DataFrame:
    """An order and a fill far behind all others, which move the watermark on and wait for ever."""
    micros = 1_705_276_800_000_000 + seconds * 1_000_000  # from the same midnight
    fields = {"order": {"WTH": "9999999", "SBJG": "", "WTSL": "1"}, "fill": {"WTH": "8888888", "CJBH": "1", "CXBZ": "O", "KHH": "CUST1"}}
    rows = [
        (T.KIND_TOPIC[kind], 0, seconds, json.dumps({"optype": "INSERT", "rowid": "R", "jstime": str(micros), "after": after}))
        for kind, after in fields.items()
    ]
    return spark.createDataFrame(rows, S.RAW_SCHEMA)


def _in_state(spark: SparkSession, sf: str, name: str, waves: Sequence[DataFrame], build, mode: str, measure, replace: bool = False) -> Totals:
    """Land each wave and run ``build``'s stream over it from its checkpoint, into running totals.

    The messages of a wave are taken away once they are committed.
    """
    root = work_folder(spark, name)
    totals = Totals(StepTables(spark, f"{root}/job"))
    for wave in waves:
        _land(spark, wave, f"{root}/landing")
        stream = build(read_change_files(spark, f"{root}/landing"))
        writer = stream.writeStream.outputMode(mode).foreachBatch(into_totals(totals, measure, replace))
        with state_on_disk(spark):
            query = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        totals.tables.delete(f"{root}/landing")
    return totals


def _timed(raw: DataFrame, kind: str, *columns: str) -> DataFrame:
    """Records with a source time; named columns alone are shuffled and kept in the state."""
    parsed = parse_envelopes(raw, kinds=[kind])
    rows = P.records(parsed, kind, DAY, T.DESK_RULES).where("event_ts IS NOT NULL")
    return rows.select("event_ts", *columns) if columns else rows


#: What fills are told apart and counted by.
_COUNTED = (*FILL_KEY, "branch", "currency", "fill_amt", "commission", "holder_acct")


def stream_fills_in_state(spark: SparkSession, sf: str) -> DataFrame:
    """Fills delivered twice, once each, joined to orders that come later; the rest leave unmatched."""
    width = _stretch(spark, sf)
    delay = f"{2 * width} seconds"

    def build(raw: DataFrame) -> DataFrame:
        fills = once_within(_timed(raw, "fill", *_COUNTED), FILL_KEY, delay)
        orders = once_within(_timed(raw, "order", *ORDER_KEY, "channel"), ORDER_KEY, delay)
        return fills_with_orders(fills, orders, "1 minute", "1 minute")

    waves = [*_timed_waves(spark, sf, width, True), _later(spark, 100 * width)]
    measure = lambda batch: M.fill_metrics(batch, T.rates(spark))
    totals = _in_state(spark, sf, "fills-state", waves, build, "append", measure)
    return totals.rows(TRADE).select("branch", "channel", "mtch_tims", "mtch_amt", "tot_cms")


def stream_fills_within_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Fills delivered again within the watermark count once."""
    width = _stretch(spark, sf)

    def build(raw: DataFrame) -> DataFrame:
        return once_within(_timed(raw, "fill", *_COUNTED), FILL_KEY, f"{2 * width} seconds").withColumn("channel", F.lit("any"))

    measure = lambda batch: M.fill_metrics(batch, T.rates(spark))
    totals = _in_state(spark, sf, "fills-once-state", _timed_waves(spark, sf, width, True), build, "append", measure)
    return totals.rows(TRADE).select("branch", "mtch_tims", "mtch_amt", "tot_cms")


def stream_totals_in_state(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals carried on in the state store over restarts, written whole for each changed key."""

    def build(raw: DataFrame) -> DataFrame:
        return running_totals(M.order_rows(_timed(raw, "order")), T.rates(spark))

    totals = _in_state(spark, sf, "totals-state", _order_waves(spark, sf), build, "update", lambda batch: batch, replace=True)
    return totals.rows(TRADE).select(
        "business_date", "branch", "channel", "entr_tims", "entr_amt", "marg_entr_tims", "stoc_entr_tims"
    )


_ORDERS = f"""WITH {T.RATES_SQL}, o AS (
    SELECT o_orderkey, o_custkey, substr(o_orderpriority, 1, 1) AS branch, {T.CHANNEL_SQL} AS channel, o_orderstatus,
           CAST(o_totalprice AS DECIMAL(18,4)) AS price FROM orders WHERE o_orderkey <> 0),
    f AS (SELECT l_orderkey, l_suppkey, concat_ws('-', l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'), CAST(l_extendedprice AS DECIMAL(18,4))) AS fill_id,
           l_linestatus AS branch, CAST(l_extendedprice AS DECIMAL(18,4)) AS fill_amt,
           CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS commission
        FROM lineitem WHERE l_orderkey <> 0 AND l_linestatus = 'O')"""

# An update that arrives first counts at once if its own fields suffice, and
# only otherwise waits for its request.
OTC_STREAM_SQL = f"""{A.OTC_WITH}, own AS (
    SELECT business_date, order_id, biz_amt, CASE WHEN proc_result = '1' AND biz_code = '1' THEN 'otc_acc'
        WHEN proc_result = '1' AND biz_code <> '1' AND prod_class = '14' THEN 'ins' END AS metric
    FROM lst WHERE op = 'UPDATE' AND proc_status = '2'),
streamed AS (
    SELECT business_date, metric, biz_amt FROM outcomes WHERE op = 'INSERT'
    UNION ALL SELECT business_date, metric, CASE metric WHEN 'ins' THEN biz_amt ELSE 0 END FROM own WHERE metric IS NOT NULL
    UNION ALL SELECT f.business_date, CASE WHEN f.biz_code = '1' THEN 'otc_acc' ELSE 'ins' END,
        CASE WHEN f.biz_code = '1' THEN 0 ELSE f.biz_amt END
    FROM filled f JOIN own o ON o.business_date = f.business_date AND o.order_id = f.order_id
    WHERE o.metric IS NULL AND f.proc_result = '1' AND (f.biz_code = '1' OR f.prod_class = '14'))
SELECT business_date, metric, count(*) AS n, CAST(sum(biz_amt) AS DECIMAL(38,12)) AS amount FROM streamed GROUP BY 1, 2"""

ORDERS_TOTAL_SQL = (
    _ORDERS
    + f"""SELECT {DAY} AS business_date, branch, channel, count(*) AS entr_tims,
        CAST(sum(CAST(CAST(2 * price AS DECIMAL(20,4)) * 6.9876 AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS entr_amt,
        count(*) FILTER (WHERE branch = '5' AND o_orderstatus = 'O') AS marg_entr_tims, count(*) AS stoc_entr_tims
        FROM o GROUP BY 2, 3"""
)
FILLS_TOTAL_SQL = (
    _ORDERS
    + """SELECT f.branch, coalesce(o.channel, 'undefine') AS channel, count(*) AS mtch_tims,
        CAST(sum(CAST(CAST(fill_amt AS DECIMAL(20,4)) * 7.80015 AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS mtch_amt,
        CAST(sum(commission) AS DECIMAL(38,4)) AS tot_cms
        FROM f LEFT JOIN o ON o_orderkey = l_orderkey AND o_orderstatus <> 'P' GROUP BY 1, 2"""
)
TRADE_TABLE_SQL = (
    _ORDERS
    + f""", e AS (SELECT branch, channel, count(*) AS entr_tims, count(DISTINCT o_custkey) AS entr_cust_nums,
        CAST(sum(CAST(CAST(2 * price AS DECIMAL(20,4)) * 6.9876 AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS entr_amt
        FROM o WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
    m AS (SELECT f.branch, coalesce(o.channel, 'undefine') AS channel, count(*) AS mtch_tims, count(DISTINCT l_suppkey) AS mtch_cust_nums,
        CAST(sum(CAST(CAST(fill_amt AS DECIMAL(20,4)) * 7.80015 AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS mtch_amt,
        CAST(sum(commission) AS DECIMAL(38,4)) AS tot_cms
        FROM f LEFT JOIN o ON o_orderkey = l_orderkey AND o_orderstatus <> 'P' GROUP BY 1, 2)
    SELECT {DAY} AS date_id, branch AS dept, channel AS trd_chn, coalesce(entr_tims, 0) AS entr_tims, coalesce(entr_amt, 0) AS entr_amt,
        coalesce(entr_cust_nums, 0) AS entr_cust_nums, coalesce(mtch_tims, 0) AS mtch_tims, coalesce(mtch_amt, 0) AS mtch_amt,
        coalesce(tot_cms, 0) AS tot_cms, coalesce(mtch_cust_nums, 0) AS mtch_cust_nums
    FROM e FULL JOIN m USING (branch, channel)"""
)
OTC_TABLE_SQL = (
    OTC_STREAM_SQL.rsplit("\nSELECT", 1)[0]
    + " SELECT business_date AS date_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE metric = '{k}') AS {k}_entr_tims, "
        f"CAST(coalesce(sum(biz_amt) FILTER (WHERE metric = '{k}'), 0) AS DECIMAL(38,12)) AS {k}_mtch_amt"
        for k in ("ins", "crrc", "not_crrc")
    )
    + " FROM streamed GROUP BY 1"
)

QUERIES: dict[str, tuple[Query, str | None]] = {
    "stream_cold_start": (stream_cold_start, ORDERS_TOTAL_SQL),
    "stream_trade_stat": (stream_trade_stat, TRADE_TABLE_SQL),
    "stream_otc_stat": (stream_otc_stat, OTC_TABLE_SQL),
    "stream_late_topic": (stream_late_topic, FILLS_TOTAL_SQL),
    "stream_fills_in_state": (stream_fills_in_state, FILLS_TOTAL_SQL),
    "stream_totals_in_state": (stream_totals_in_state, ORDERS_TOTAL_SQL),
    "stream_fills_within_watermark": (
        stream_fills_within_watermark,
        _ORDERS
        + """SELECT branch, count(*) AS mtch_tims,
        CAST(sum(CAST(CAST(fill_amt AS DECIMAL(20,4)) * 7.80015 AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS mtch_amt,
        CAST(sum(commission) AS DECIMAL(38,4)) AS tot_cms FROM f GROUP BY 1""",
    ),
    "stream_fills_once": (stream_fills_once, FILLS_TOTAL_SQL),
    "stream_late_pending": (
        stream_late_pending,
        _ORDERS
        + """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, fill_id, 5 AS attempts FROM f
        WHERE NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
    ),
    "stream_cdc_ingest": (stream_cdc_ingest, cdc.ROUTE_SQL),
    "stream_orders_running_total": (
        stream_orders_running_total,
        ORDERS_TOTAL_SQL,
    ),
    "stream_distinct_customers": (
        stream_distinct_customers,
        _ORDERS + "SELECT branch, channel, count(DISTINCT o_custkey) AS entr_cust_nums FROM o GROUP BY 1, 2",
    ),
    "stream_fills_late_match": (
        stream_fills_late_match,
        FILLS_TOTAL_SQL,
    ),
    "stream_pending": (
        stream_pending,
        _ORDERS
        + """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, fill_id, 2 AS attempts FROM f
        WHERE NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
    ),
    "stream_batch_ledger": (
        stream_batch_ledger,
        """SELECT 'SECURITIES_TDRWT' AS topic, 0 AS step, count(*) AS n FROM orders
        UNION ALL SELECT 'SECURITIES_TSSCJ', 2, count(*) FROM lineitem""",
    ),
    "stream_otc_late_match": (stream_otc_late_match, OTC_STREAM_SQL),
    "stream_dept_late_match": (stream_dept_late_match, A.QUERIES["dept_stat_daily"][1]),
    "stream_state_retention": (
        stream_state_retention,
        f"""WITH {T.EVENTS_SQL}, {T.event_records_sql('dept_request')}, {A.REQUESTS_SQL}
        SELECT business_date, request_id, branch, proc_status FROM req WHERE op = 'INSERT' AND business_date >= {RETAINED_FROM}""",
    ),
    "stream_activity_daily": (
        stream_activity_daily,
        A.QUERIES["other_stat_daily"][1].replace(
            "WHERE metric = 'otc_acc' GROUP BY 1)", "WHERE false GROUP BY 1)"
        ),
    ),
}
