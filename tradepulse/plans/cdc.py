"""Catalogue: change messages rendered from the tables, parsed and projected back.

Topic names and upper-case field names of the messages are fixed values (see schemas.py).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E
from tradepulse.operators import project as P
from tradepulse.operators.ingest import (
    drop_empty,
    parse_envelopes,
    route_counts,
    unwrap_late,
)
from tradepulse.plans import tables as T

Query = Callable[[SparkSession, str], DataFrame]

ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
LATE_TOPIC = "LATE_RECORDS"
ORDER_DAY_SQL = "CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER)"


def envelope(op: Column, offset: Column, ts: Column | None, after: Column, **more: Column) -> Column:
    """JSON text of one change message."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    fields = [op.alias("optype"), offset.cast("string").alias("rowid")]
    if ts is not None:
        micros = F.timestamp_diff("MICROSECOND", zero, ts).cast("string")
        fields.append(F.lpad(micros, 16, "0").alias("jstime"))
    fields += [column.alias(name) for name, column in more.items()]
    return F.to_json(F.struct(*fields, after.alias("after")))


def _message(topic: Column, offset: Column, value: Column) -> list[Column]:
    return [
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        offset.alias("offset"),
        value.alias("value"),
    ]


def _order_after(**changed: Column) -> Column:
    columns = {
        "KHH": F.concat(F.lit("CUST"), F.col("o_custkey").cast("string")),
        "WTH": F.col("o_orderkey").cast("string"),
        "YYB": F.substring("o_orderpriority", 1, 1),
        "WTFS": F.col("o_orderstatus"),
        "WTGY": F.col("o_orderpriority"),
        "BZ": F.lit("ASIA"),
        "WTSL": F.lit("2"),
        "WTJG": F.col("o_totalprice").cast(S.MONEY).cast("string"),
        "CXBZ": F.col("o_orderstatus"),
        "JSLX": F.substring("o_orderpriority", 1, 1),
        "ZQLB": F.lit("A0"),
        **changed,
    }
    return F.struct(*[c.alias(n) for n, c in columns.items()])


def order_op() -> Column:
    """Pending orders are updates; low-priority ones are spelled in lower case."""
    return (
        F.when(F.col("o_orderstatus") == "P", "UPDATE")
        .when(F.col("o_orderpriority") == "5-LOW", "insert")
        .otherwise("INSERT")
    )


def order_messages(
    spark: SparkSession, sf: str, op: Column | None = None, keep: Column | None = None, ts: Column | None = None
) -> DataFrame:
    seen = F.col("o_orderdate") if ts is None else ts
    value = envelope(order_op() if op is None else op, F.col("o_orderkey"), seen, _order_after())
    orders = T.load_spread(spark, sf, "orders", *ORDER_COLUMNS)
    if keep is not None:
        orders = orders.where(keep)
    return orders.select(*_message(F.lit(T.KIND_TOPIC["order"]), F.col("o_orderkey"), value))


def fill_after(unique: bool = False) -> Column:
    """``unique`` spells the fill id from enough columns to tell all lines apart."""
    price = F.col("l_extendedprice").cast(S.MONEY)
    fill_id = F.col("l_linenumber").cast("string")
    if unique:
        day = E.day_int("l_shipdate")
        parts = (fill_id, F.col("l_partkey"), F.col("l_suppkey"), day, price)
        fill_id = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.struct(
        F.concat(F.lit("CUST"), F.col("l_suppkey").cast("string")).alias("KHH"),
        fill_id.alias("CJBH"),
        F.col("l_linestatus").alias("YYB"),
        F.lit(" europe ").alias("BZ"),
        price.cast("string").alias("CJJE"),
        (price * F.col("l_discount").cast("decimal(4,2)")).cast(S.MONEY).cast("string").alias("S1"),
        F.when(F.col("l_returnflag") == "A", F.lower("l_linestatus"))
        .otherwise(F.col("l_linestatus"))
        .alias("CXBZ"),
        F.col("l_orderkey").cast("string").alias("WTH"),
        F.col("l_returnflag").alias("GDH"),
    )


def fill_messages(
    spark: SparkSession, sf: str, op: Column | None = None, unique: bool = False, keep: Column | None = None,
    ts: Column | None = None,
) -> DataFrame:
    lines = T.load_spread(spark, sf, "lineitem", *LINE_COLUMNS)
    if keep is not None:
        lines = lines.where(keep)
    offset = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    if op is None:
        op = F.when(F.col("l_returnflag") == "N", "insert").otherwise("INSERT")
    value = envelope(op, offset, F.col("l_shipdate") if ts is None else ts, fill_after(unique))
    return lines.select(*_message(F.lit(T.KIND_TOPIC["fill"]), offset, value))


# -- queries -------------------------------------------------------------------


def cdc_roundtrip_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Records parsed, rendered as JSON again, and read back."""
    parsed = parse_envelopes(order_messages(spark, sf, op=F.lit("INSERT")), kinds=["order"])
    orders = P.records(parsed, "order", zone="UTC")
    fields = [f.name for f in S.FIELDS["order"]]
    text = orders.select("business_date", E.as_json(*fields).alias("text"))
    back = text.select(
        "business_date", F.inline(F.array(F.from_json("text", S.record_schema("order"))))
    )
    return back.select(
        "order_id", "customer_id", "branch", "entry_mode", "entry_operator", "qty", "price",
        "report_result", "business_date",
    )


def cdc_project_orders(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_envelopes(order_messages(spark, sf), kinds=["order"])
    orders = P.records(parsed, "order", rules=T.DESK_RULES, zone="UTC")
    return orders.select(
        "order_id", "customer_id", "branch", "channel", "qty", "price", "sec_class", "business_date"
    )


def cdc_project_fills(spark: SparkSession, sf: str) -> DataFrame:
    fills = P.records(parse_envelopes(fill_messages(spark, sf), kinds=["fill"]), "fill", zone="UTC")
    return fills.select(
        "order_id", "fill_id", "customer_id", "branch", "currency", "fill_amt", "commission",
        "cancel_flag", "holder_acct", "business_date",
    )


def _project_events(kind: str, columns: list[str]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        parsed = parse_envelopes(T.event_messages(spark, sf, kind), kinds=[kind])
        rows = P.records(parsed, kind)
        return rows.select(F.col("src_offset").alias("event_id"), "op", "business_date", *columns)

    return query


def cdc_quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders damaged in seven ways, by status and priority."""
    orders = T.load_spread(spark, sf, "orders", *ORDER_COLUMNS)
    filled = F.col("o_orderstatus") == "F"
    is_open = F.col("o_orderstatus") == "O"
    priority = F.substring("o_orderpriority", 1, 1)
    after = _order_after(
        WTSL=F.when(filled & (priority == "3"), "abc").otherwise("2"),
        KHH=F.when(filled & (priority == "4"), "CUSTx9").otherwise("CUST9"),
        WTH=F.when(filled & (priority == "5"), "W12").otherwise(F.col("o_orderkey").cast("string")),
    )
    text = envelope(F.lit("INSERT"), F.col("o_orderkey"), F.col("o_orderdate"), after)
    request = envelope(
        F.lit("INSERT"), F.col("o_orderkey"), None, F.struct(F.col("o_orderpriority").alias("ID"))
    )
    nulled = F.replace(text, F.lit('"BZ":"ASIA"'), F.lit('"BZ":null'))
    value = (
        F.when(filled & (priority == "1"), F.concat(F.lit(" "), F.regexp_replace(text, "}$", "")))
        .when(is_open & (priority == "1"), nulled)
        .when(is_open & (priority == "2"), request)
        .otherwise(text)
    )
    topic = (
        F.when(filled & (priority == "2"), "SOMETHING_ELSE")
        .when(is_open & (priority == "2"), T.KIND_TOPIC["dept_request"].lower())
        .otherwise(T.KIND_TOPIC["order"])
    )
    parsed = parse_envelopes(orders.select(*_message(topic, F.col("o_orderkey"), value)))
    bad = P.quarantine(parsed, ("order", "dept_request")).groupBy("reject_reason")
    good = P.records(parsed, "order").select(F.lit("kept").alias("reject_reason"))
    return bad.agg(F.count(F.lit(1)).alias("n")).unionByName(
        good.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    )


def cdc_null_vs_missing(spark: SparkSession, sf: str) -> DataFrame:
    """One field as JSON null, absent, or given, in two kinds."""
    base = T.events_base(spark, sf, wide=True)

    def messages(kind: str, field: str, **fixed: Column) -> DataFrame:
        def text(value: Column | None, nulls: str) -> Column:
            extra = [] if value is None else [value.alias(field)]
            after = F.struct(*[c.alias(n) for n, c in fixed.items()], *extra)
            head = [
                F.lit("INSERT").alias("optype"),
                F.col("event_id").cast("string").alias("rowid"),
                F.col("micros").cast("string").alias("jstime"),
            ]
            return F.to_json(F.struct(*head, after.alias("after")), {"ignoreNullFields": nulls})

        value = (
            F.when(F.col("event_type") == "view", text(F.lit(None).cast("string"), "false"))
            .when(F.col("event_type") == "click", text(None, "true"))
            .otherwise(text(F.lit("given"), "true"))
        )
        rows = base.select(*_message(F.lit(T.KIND_TOPIC[kind]), F.col("event_id"), value))
        return P.records(parse_envelopes(rows), kind)

    customers = messages("customer", "XHRQ", KHH=F.lit("CUST1"))
    requests = messages("dept_request", "KHH", ID=F.lit("Q1"))
    both = customers.select(F.lit("close_date").alias("field"), F.col("close_date").alias("value"))
    both = both.unionByName(
        requests.select(F.lit("customer_id").alias("field"), F.col("customer_id").alias("value"))
    )
    return both.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


EVENT_KINDS = tuple(T.EVENT_MESSAGES)


def all_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, fills and every event kind in one raw stream."""
    out = order_messages(spark, sf).unionByName(fill_messages(spark, sf))
    return out.unionByName(T.event_messages(spark, sf, *EVENT_KINDS))


def cdc_route_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = route_counts(parse_envelopes(all_messages(spark, sf), fields=False))
    return counts.select("kind", "op", "n")


def cdc_empty_and_keyless(spark: SparkSession, sf: str) -> DataFrame:
    """Bank-account messages: null and empty texts, then empty account ids."""
    raw = T.event_messages(spark, sf, "bank_account").join(
        T.load(spark, sf, "events").select(F.col("event_id").alias("offset"), "event_type"), "offset"
    )
    raw = raw.withColumn(
        "value",
        F.when(F.col("event_type") == "error", F.lit(""))
        .when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .otherwise(F.col("value")),
    )
    total = raw.agg(F.count(F.lit(1)).alias("n")).select(F.lit("all").alias("step"), "n")
    full = drop_empty(raw).agg(F.count(F.lit(1)).alias("n")).select(F.lit("non_empty").alias("step"), "n")
    kept = P.records(parse_envelopes(raw), "bank_account")
    keyed = kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("keyed").alias("step"), "n")
    return total.unionByName(full).unionByName(keyed)


def cdc_order_transitions(spark: SparkSession, sf: str) -> DataFrame:
    """Order updates whose report result turns 2."""
    orders = T.load_spread(spark, sf, "orders", *ORDER_COLUMNS)
    before = F.struct(
        F.col("o_orderkey").cast("string").alias("WTH"),
        F.when(F.col("o_orderstatus") == "F", " 2 ").otherwise("0").alias("SBJG"),
    )
    after = _order_after(
        SBJG=F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "2 ").otherwise("1")
    )
    value = envelope(
        F.lit("UPDATE"), F.col("o_orderkey"), F.col("o_orderdate"), after, before=before
    )
    raw = orders.select(*_message(F.lit(T.KIND_TOPIC["order"]), F.col("o_orderkey"), value))
    return P.order_transitions(parse_envelopes(raw, before=True)).select("order_id", "report_result")


def _wrapped(origin: str, offset: Column, record: Column) -> list[Column]:
    text = F.to_json(F.struct(F.lit(origin).alias("originTopic"), record.alias("baseRecord")))
    return _message(F.lit(LATE_TOPIC), offset, text)


def late_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    """Fills, branch and OTC requests and a stranger, wrapped and read back."""
    lines = T.load_spread(spark, sf, "lineitem", *LINE_COLUMNS)
    fills = lines.select(
        *_wrapped(
            "SECURITIES_TSSCJ",
            F.col("l_orderkey"),
            F.struct(
                F.concat(F.lit("cust"), F.col("l_suppkey").cast("string")).alias("khh"),
                F.col("l_linenumber").cast("string").alias("cjbh"),
                F.lower("l_linestatus").alias("cxbz"),
                F.col("l_extendedprice").cast(S.MONEY).alias("cjje"),
                F.col("l_orderkey").cast("string").alias("wth"),
                F.lit("06").alias("gdh"),
                F.lit("asia").alias("bz"),
                F.col("l_linenumber").alias("version"),
            ),
        )
    )
    base = T.events_base(spark, sf, wide=True)
    requests = base.select(
        *_wrapped(
            "securities_tywqq",
            F.col("event_id"),
            F.struct(
                F.col("event_type").alias("id"),
                F.lit("8").alias("clzt"),
                F.col("utc_day").alias("sqrq"),
                F.lit("b1").alias("yyb"),
                F.lit(3).alias("version"),
            ),
        )
    )
    otc = base.select(
        *_wrapped(
            "SECURITIES_TYWSQLSKH",
            F.col("event_id"),
            F.struct(
                F.col("user_id").cast("string").alias("wth"),
                F.lit("2").alias("clzt"),
                F.lit("1").alias("ywdm"),
                F.col("amt").alias("ywje"),
            ),
        )
    )
    other = base.where("event_type = 'error'").select(
        *_wrapped("SOMEWHERE", F.col("event_id"), F.struct(F.col("event_type").alias("id")))
    )
    raw = fills.unionByName(requests).unionByName(otc).unionByName(other)

    def counted(kind: str, key: str, amount: Column) -> DataFrame:
        rows = P.late_records(unwrap_late(raw, LATE_TOPIC, kinds=[kind]), kind, 20240115)
        return rows.groupBy(F.lit(kind).alias("kind"), "op", "attempts", F.col(key).alias("key")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(amount).cast("decimal(38,4)").alias("amount")
        )

    strangers = unwrap_late(raw, LATE_TOPIC, kinds=()).where("reject_reason = 'unknown_topic'").groupBy(
        F.lit("unknown").alias("kind"),
        F.lit(None).cast("string").alias("op"),
        F.lit(None).cast("int").alias("attempts"),
        F.lit(None).cast("string").alias("key"),
    )
    return (
        counted("fill", "cancel_flag", F.col("fill_amt"))
        .unionByName(counted("dept_request", "request_id", F.lit(0).cast(S.MONEY)))
        .unionByName(counted("otc", "biz_code", F.col("biz_amt")))
        .unionByName(
            strangers.agg(
                F.count(F.lit(1)).alias("n"), F.lit(0).cast("decimal(38,4)").alias("amount")
            )
        )
    )


EVENT_COLUMNS = {
    "customer": ["customer_id", "open_date", "cust_type_code", "cust_status", "close_date"],
    "cash": ["customer_id", "ledger_id", "subject", "currency", "amt_in", "amt_out"],
    "otc": ["order_id", "customer_id", "biz_code", "proc_status", "proc_result", "prod_class", "biz_amt", "reg_date", "prod_id"],
    "stock_account": ["customer_id", "holder_acct", "open_date", "holder_status", "acct_class"],
    "bank_account": ["customer_id", "bank_acct", "open_date", "acct_status"],
    "dept_request": ["request_id", "customer_id", "request_date", "branch", "proc_status"],
    "fund_account": ["customer_id", "fund_acct", "open_date", "acct_status"],
}


def _project_sql(kind: str) -> str:
    columns = ", ".join(["event_id", "op", "business_date", *EVENT_COLUMNS[kind]])
    return f"WITH {T.EVENTS_SQL}, {T.event_records_sql(kind)} SELECT {columns} FROM {kind}"


_FILL_OP_SQL = "CASE WHEN l_returnflag = 'N' THEN 'insert' ELSE 'INSERT' END"
_ORDER_OP_SQL = "CASE WHEN o_orderstatus = 'P' THEN 'UPDATE' WHEN o_orderpriority = '5-LOW' THEN 'insert' ELSE 'INSERT' END"
ROUTE_SQL = f"""WITH {T.EVENTS_SQL}
    SELECT kind, op, count(*) AS n FROM (
        SELECT 'order' AS kind, {_ORDER_OP_SQL} AS op FROM orders
        UNION ALL SELECT 'fill', {_FILL_OP_SQL} FROM lineitem
        {' '.join(f"UNION ALL SELECT '{k}', {T.EVENT_MESSAGES[k]['op']} FROM ev" for k in EVENT_KINDS)}) AS m
    GROUP BY 1, 2"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "cdc_roundtrip_orders": (
        cdc_roundtrip_orders,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'CUST' || o_custkey AS customer_id, substr(o_orderpriority, 1, 1) AS branch,
        o_orderstatus AS entry_mode, o_orderpriority AS entry_operator, 2 AS qty, CAST(o_totalprice AS DECIMAL(18,4)) AS price,
        '' AS report_result, {ORDER_DAY_SQL} AS business_date FROM orders WHERE o_orderkey <> 0""",
    ),
    "cdc_project_orders": (
        cdc_project_orders,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'CUST' || o_custkey AS customer_id, substr(o_orderpriority, 1, 1) AS branch,
        {T.CHANNEL_SQL} AS channel, 2 AS qty, CAST(o_totalprice AS DECIMAL(18,4)) AS price, 'A0' AS sec_class,
        {ORDER_DAY_SQL} AS business_date FROM orders WHERE o_orderkey <> 0 AND {_ORDER_OP_SQL} = 'INSERT'""",
    ),
    "cdc_project_fills": (
        cdc_project_fills,
        """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS fill_id, 'CUST' || l_suppkey AS customer_id,
        l_linestatus AS branch, ' europe ' AS currency, CAST(l_extendedprice AS DECIMAL(18,4)) AS fill_amt,
        CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS commission,
        CASE WHEN l_returnflag = 'A' THEN lower(l_linestatus) ELSE l_linestatus END AS cancel_flag, l_returnflag AS holder_acct,
        CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS business_date
        FROM lineitem WHERE l_orderkey <> 0 AND l_linestatus = 'O'""",
    ),
    **{
        f"cdc_project_{short}": (_project_events(kind, EVENT_COLUMNS[kind]), _project_sql(kind))
        for short, kind in (
            ("customers", "customer"),
            ("cash", "cash"),
            ("otc", "otc"),
            ("stock", "stock_account"),
            ("bank", "bank_account"),
            ("requests", "dept_request"),
            ("fund", "fund_account"),
        )
    },
    "cdc_quarantine_counts": (
        cdc_quarantine_counts,
        """SELECT reject_reason, count(*) AS n FROM (SELECT o_orderkey, CASE o_orderstatus || substr(o_orderpriority, 1, 1)
            WHEN 'F1' THEN 'malformed_json' WHEN 'F2' THEN 'unknown_topic' WHEN 'F3' THEN 'bad_number'
            WHEN 'F4' THEN 'bad_customer_id' WHEN 'F5' THEN 'bad_order_id' WHEN 'O1' THEN 'null_field'
            WHEN 'O2' THEN 'bad_source_time' ELSE 'kept' END AS reject_reason FROM orders) AS r
        WHERE o_orderkey <> 0 OR reject_reason <> 'kept' GROUP BY 1""",
    ),
    "cdc_null_vs_missing": (
        cdc_null_vs_missing,
        """SELECT f.field, CASE event_type WHEN 'view' THEN 'nvl' WHEN 'click' THEN '0' ELSE 'given' END AS value, count(*) AS n
        FROM events CROSS JOIN (VALUES ('close_date'), ('customer_id')) AS f(field) GROUP BY 1, 2""",
    ),
    "cdc_route_counts": (cdc_route_counts, ROUTE_SQL),
    "cdc_empty_and_keyless": (
        cdc_empty_and_keyless,
        f"""WITH {T.EVENTS_SQL}, {T.event_records_sql('bank_account')}
        SELECT 'all' AS step, count(*) AS n FROM events
        UNION ALL SELECT 'non_empty', count(*) FROM events WHERE event_type NOT IN ('error', 'view')
        UNION ALL SELECT 'keyed', count(*) FROM bank_account JOIN events USING (event_id) WHERE event_type NOT IN ('error', 'view')""",
    ),
    "cdc_order_transitions": (
        cdc_order_transitions,
        """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '2' AS report_result FROM orders
        WHERE o_orderkey <> 0 AND o_orderstatus <> 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    ),
    "late_unwrap": (
        late_unwrap,
        """SELECT 'fill' AS kind, 'INSERT' AS op, l_linenumber AS attempts, 'O' AS key, count(*) AS n,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS amount
        FROM lineitem WHERE l_linestatus = 'O' AND l_orderkey <> 0 GROUP BY 3
        UNION ALL SELECT 'dept_request', 'UPDATE', 3, upper(event_type), count(*), 0 FROM events GROUP BY 4
        UNION ALL SELECT 'otc', 'UPDATE', 0, '1', count(*), CAST(sum(CAST(value AS DECIMAL(18,4))) AS DECIMAL(38,4)) FROM events WHERE user_id <> 0
        UNION ALL SELECT 'unknown', NULL, NULL, NULL, count(*), 0 FROM events WHERE event_type = 'error'""",
    ),
}
