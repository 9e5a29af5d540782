"""The catalogue's view of the given tables as brokerage records.

Orders are ``orders``, fills are ``lineitem``, and ``events`` supplies customer,
cash, account and request messages. The same expressions describe a record in
Spark and in the SQL check, so a difference can only come from an operator.

Topic and field names of the messages are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E
from tradepulse.functions.rules import Rules, classify
from tradepulse.operators.project import accepted
from tradepulse.sources.changes import spread
from tradepulse.sources.dimensions import latest_products, latest_rates

# A rule file in the usual form, over the order table's own codes.
DESK_RULES: Rules = {
    "desk": [
        {"entry_operator": ["1-URGENT", "2-HIGH"], "entry_mode": ["F"]},
    ],
    "web": [
        {"entry_operator": ["3-MEDIUM"], "entry_mode": ["O", "P"]},
        {"entry_operator": ["1-URGENT"], "entry_mode": ["P"]},
    ],
    "mobile": [
        {"entry_operator": ["4-NOT SPECIFIED", "5-LOW"], "entry_mode": ["O"]},
        {"entry_operator": ["5-LOW"], "entry_mode": ["F"]},
        {"entry_operator": ["1-URGENT"], "entry_mode": ["P", "O"]},
    ],
    "none": [{}],
}

CHANNEL_SQL = """CASE
    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' THEN 'desk'
    WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus IN ('O', 'P') THEN 'web'
    WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'web'
    WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') AND o_orderstatus = 'O' THEN 'mobile'
    WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'mobile'
    WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'mobile'
    ELSE 'qt' END"""

RATE_ROWS = """
    (' asia ', 7.1234D, '202312', '30'), ('ASIA', 6.9876D, '202401', '02'),
    ('europe', 7.80015D, '202401', '02'), (' America', 0.00031415D, '202401', '02'),
    ('AFRICA', 0.5D, '202312', '31')"""

# what the newest snapshot holds, by clean key
RATES_SQL = """rates AS (
    SELECT currency, CAST(rate AS DECIMAL(15,8)) AS rate FROM (VALUES
    ('ASIA', '6.9876'), ('EUROPE', '7.80015'), ('AMERICA', '0.00031415')) AS t(currency, rate))"""

ORDERS_SQL = f"""ord AS (
    SELECT o_orderkey AS order_id, c_name AS customer_id, n_name AS branch,
           upper(trim(r_name)) AS currency, CAST(o_totalprice AS DECIMAL(18,4)) AS price,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS business_date,
           o_orderstatus AS entry_mode, o_orderpriority AS entry_operator,
           o_orderstatus AS cancel_flag, substr(o_orderpriority, 1, 1) AS settle_type,
           c_mktsegment AS sec_class, {CHANNEL_SQL} AS channel
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FILLS_SQL = """fil AS (
    SELECT l_orderkey AS order_id, l_linenumber AS fill_id, s_name AS customer_id,
           n_name AS branch, upper(trim(r_name)) AS currency,
           CAST(l_extendedprice AS DECIMAL(18,4)) AS fill_amt,
           CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS commission,
           CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS business_date,
           l_returnflag AS holder_acct, l_linestatus AS cancel_flag
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

# Orders already on the book: pending ones have not arrived.
BOOK_SQL = f"""book AS (
    SELECT o_orderkey AS order_id, {CHANNEL_SQL} AS channel FROM orders WHERE o_orderstatus <> 'P')"""

# Names are 'Customer#000000001', 'Supplier#000000001': the number starts at 10.
NAME_ORDINAL = 10
# Holder account here is the return flag; R stands for a margin account.
MARGIN_FLAG = ("R",)


# The day that rows of many dates are taken for, where ids are to meet within a day.
ONE_DAY = 20240115


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def load_spread(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Named columns of a table, dealt out for rendering and parsing text."""
    return spread(load(spark, sf_dir, table).select(*columns), text_partitions(spark))


def text_partitions(spark: SparkSession) -> int:
    """Tasks that render and parse text: as many as the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rate_history(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {RATE_ROWS} AS t(bz, gsbl, month_id, day_id)")


def rates(spark: SparkSession) -> DataFrame:

    return latest_rates(rate_history(spark))


def channel() -> Column:
    return classify(
        DESK_RULES, {"entry_operator": "o_orderpriority", "entry_mode": "o_orderstatus"}
    )


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("branch"), F.col("r_name").alias("currency")
    )


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    customer = load(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        branches(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("c_name").alias("customer_id"),
        "branch",
        "currency",
        F.lit(1).alias("qty"),
        F.col("o_totalprice").cast(S.MONEY).alias("price"),
        E.day_int("o_orderdate").alias("business_date"),
        F.col("o_orderstatus").alias("entry_mode"),
        F.col("o_orderpriority").alias("entry_operator"),
        F.col("o_orderstatus").alias("cancel_flag"),
        F.substring("o_orderpriority", 1, 1).alias("settle_type"),
        F.col("c_mktsegment").alias("sec_class"),
        channel().alias("channel"),
    )


def fills_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem")
    supplier = load(spark, sf_dir, "supplier")
    price = F.col("l_extendedprice").cast(S.MONEY)
    joined = lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey).join(
        branches(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("fill_id"),
        F.col("s_name").alias("customer_id"),
        "branch",
        "currency",
        price.alias("fill_amt"),
        (price * F.col("l_discount").cast("decimal(4,2)")).cast(S.MONEY).alias("commission"),
        E.day_int("l_shipdate").alias("business_date"),
        F.col("l_returnflag").alias("holder_acct"),
        F.col("l_linestatus").alias("cancel_flag"),
    )


def order_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have arrived, with their channel: one row per order id."""
    orders = load(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return orders.select(F.col("o_orderkey").alias("order_id"), channel().alias("channel"))


# -- events as messages ------------------------------------------------------

# Shared base columns; the two dialects spell them differently.
EVENTS_SQL = """ev AS (
    SELECT event_id, ts, user_id, event_type, value, CAST(value AS DECIMAL(18,4)) AS amt,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS utc_day,
           CAST(strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS INTEGER) AS local_day,
           CAST(epoch_us(ts) AS VARCHAR) AS micros
    FROM events)"""

_ENTER = "event_type IN ('signup', 'purchase')"
_OPS = "CASE WHEN event_type IN ('signup', 'purchase') THEN 'INSERT' WHEN event_type IN ('click', 'view') THEN 'UPDATE' ELSE 'DELETE' END"

# Per kind: the operation, then each source field as an expression over ``ev``
# that both engines accept. A null leaves the field out of the message.
EVENT_MESSAGES: dict[str, dict[str, str]] = {
    "customer": {
        "op": "CASE WHEN event_type = 'error' THEN 'DELETE' WHEN event_type = 'purchase' THEN 'UPDATE' ELSE 'INSERT' END",
        "KHH": "CASE WHEN k = 0 THEN '' ELSE concat('CUST', CAST(user_id AS STRING)) END",
        "KHRQ": "CAST(utc_day AS STRING)",
        "KHLB": "CASE WHEN k < 40 THEN '0' WHEN k < 80 THEN '1' WHEN k < 90 THEN '7' END",
        "KHZT": "CASE WHEN value < 30 THEN '3' ELSE '0' END",
        "XHRQ": "CASE WHEN event_type <> 'view' THEN CAST(utc_day AS STRING) END",
    },
    "cash": {
        "op": "CASE WHEN event_type = 'error' THEN 'UPDATE' WHEN event_type = 'view' THEN 'insert' ELSE 'INSERT' END",
        "KHH": "CASE WHEN k = 0 THEN '' ELSE concat('CUST', CAST(user_id AS STRING)) END",
        "LSH": "CASE WHEN k <> 1 THEN CAST(event_id AS STRING) END",
        "YWKM": "CASE WHEN event_type IN ('purchase', 'view') THEN '10113' WHEN event_type = 'signup' THEN '10213' ELSE '10999' END",
        "BZ": "CASE WHEN k < 25 THEN 'asia' WHEN k < 50 THEN ' Europe ' WHEN k < 75 THEN 'AMERICA' ELSE 'XXX' END",
        "SRJE": "CAST(amt AS STRING)",
        "FCJE": "CAST(amt AS STRING)",
    },
    "otc": {
        "op": _OPS,
        "WTH": "CAST(user_id AS STRING)",
        "KHH": "concat('CUST', CAST(user_id AS STRING))",
        "YWDM": f"CASE WHEN {_ENTER} THEN CASE WHEN k < 30 THEN '22' WHEN k < 60 THEN '1' WHEN k < 70 THEN '001' ELSE '7' END WHEN k >= 80 THEN '7' WHEN k >= 60 THEN '1' END",
        "CLZT": f"CASE WHEN {_ENTER} AND k < 30 THEN '0' WHEN value < 100 THEN '2' ELSE '1' END",
        "CLJG": f"CASE WHEN {_ENTER} THEN CASE WHEN value < 60 THEN '1' ELSE '0' END WHEN value >= 70 THEN '0' WHEN value >= 35 THEN '1' END",
        "CPFL": f"CASE WHEN {_ENTER} THEN CASE WHEN k < 30 THEN '5' WHEN value < 40 THEN '14' ELSE '9' END WHEN value >= 50 THEN '14' END",
        "YWJE": f"CASE WHEN {_ENTER} OR k >= 50 THEN CAST(amt AS STRING) WHEN k >= 25 THEN '0' END",
        "DJRQ": "CAST(utc_day AS STRING)",
        "CPID": "CASE WHEN k <> 7 THEN CAST(k AS STRING) END",
    },
    "stock_account": {
        "op": "CASE WHEN event_type IN ('click', 'signup', 'view') THEN 'INSERT' ELSE 'UPDATE' END",
        "KHH": "CASE WHEN k <> 0 THEN concat('CUST', CAST(user_id AS STRING)) END",
        "GDH": "CASE WHEN k = 1 THEN '' ELSE concat('E', CAST(user_id AS STRING)) END",
        "KHRQ": "CAST(utc_day AS STRING)",
        "GDZT": "CASE WHEN value < 60 THEN '0' WHEN value < 90 THEN '1' END",
        "ZHLB": "event_type",
    },
    "bank_account": {
        "op": "CASE WHEN event_type IN ('click', 'signup', 'view') THEN 'INSERT' ELSE 'UPDATE' END",
        "KHH": "CASE WHEN k <> 0 THEN concat('CUST', CAST(user_id AS STRING)) END",
        "ZJZH": "CASE WHEN k <> 1 THEN concat('Z', CAST(event_id AS STRING)) END",
        "KHRQ": "CAST(utc_day AS STRING)",
        "ZHZT": "'0'",
    },
    "dept_request": {
        "op": _OPS,
        "ID": "CASE WHEN k <> 0 THEN concat('Q', CAST(user_id AS STRING)) END",
        "KHH": "CASE WHEN k <> 1 THEN concat('CUST', CAST(user_id AS STRING)) END",
        "SQRQ": "CAST(utc_day AS STRING)",
        "YYB": "concat('B', CAST(k AS STRING))",
        "CLZT": "CASE WHEN value < 70 THEN '8' ELSE '1' END",
    },
    "fund_account": {
        "op": _OPS,
        "KHH": "CASE WHEN k <> 0 THEN concat('CUST', CAST(user_id AS STRING)) ELSE 'nvl' END",
        "JJZH": "concat('F', CAST(event_id AS STRING))",
        "KHRQ": "CAST(utc_day AS STRING)",
        "ZHZT": "CASE WHEN value < 60 THEN '8' END",
    },
}

KIND_TOPIC = {kind: topic for topic, kind in S.TOPICS.items()}


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def events_base(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Base columns of every event; ``wide`` deals them out for text work."""
    events = load(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    if wide:
        events = spread(events, text_partitions(spark))
    return events.selectExpr(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        f"CAST(value AS {S.MONEY}) AS amt",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "CAST(year(ts) * 10000 + month(ts) * 100 + dayofmonth(ts) AS INT) AS utc_day",
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS micros",
    )


def _event_message(kind: str) -> str:
    """Text of the change message of ``kind`` that stands for an event."""
    fields = EVENT_MESSAGES[kind]
    after = ", ".join(f"'{n}', {e}" for n, e in fields.items() if n != "op")
    return f"""to_json(named_struct(
            'optype', {fields['op']}, 'rowid', CAST(event_id AS STRING),
            'jstime', CAST(micros AS STRING), 'after', named_struct({after})))"""


def event_messages(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Every event as one change message of each of ``kinds``; events are read and dealt out once."""
    base = events_base(spark, sf_dir, wide=True)
    if len(kinds) == 1:
        return base.selectExpr(
            f"'{KIND_TOPIC[kinds[0]]}' AS topic", "0 AS partition", "event_id AS offset", f"{_event_message(kinds[0])} AS value"
        )
    texts = ", ".join(f"'{KIND_TOPIC[kind]}', 0, event_id, {_event_message(kind)}" for kind in kinds)
    return base.selectExpr(f"stack({len(kinds)}, {texts}) AS (topic, partition, offset, value)")


def event_records(
    spark: SparkSession, sf_dir: str, kind: str, business_date: int | None = None
) -> DataFrame:
    """The same records straight as typed columns, filtered like parsed ones."""

    given = EVENT_MESSAGES[kind]
    day = E.event_day_sql("timestamp_micros(micros)")
    fields = []
    for f in S.FIELDS[kind]:
        text = f"coalesce({given[f.source]}, '{f.missing}')"
        cast = text if f.type == "string" else f"try_cast({text} AS {f.type})"
        fields.append(f"{cast} AS {f.name}")
    typed = events_base(spark, sf_dir).selectExpr(
        "0 AS partition",
        "event_id AS offset",
        f"{given['op']} AS op",
        "CAST(event_id AS STRING) AS row_id",
        "timestamp_micros(micros) AS event_ts",
        f"{day} AS source_day",
        f"{day if business_date is None else business_date} AS business_date",
        *fields,
        "CAST(NULL AS STRING) AS reject_reason",
    )
    if kind in S.INSERT_ONLY_KINDS:
        typed = typed.where("lower(op) = 'insert'")
    return accepted(typed, kind)


_KEEP_SQL = {
    "customer": "customer_id <> ''",
    "cash": "lower(op) = 'insert' AND subject IN ('10113', '10213') AND customer_id <> '' AND ledger_id <> ''",
    "otc": "order_id <> '0' AND reg_date = CAST(business_date AS VARCHAR)",
    "stock_account": "lower(op) = 'insert' AND customer_id <> '' AND holder_acct <> '' AND open_date = business_date AND holder_status = '0'",
    "bank_account": "lower(op) = 'insert' AND customer_id <> '' AND bank_acct <> '' AND open_date = business_date",
    "dept_request": "request_id <> 'nvl'",
    "fund_account": "customer_id <> 'nvl' AND open_date = business_date AND acct_status = '8'",
}


def event_records_sql(kind: str, name: str | None = None) -> str:
    """CTE of the filtered records of a kind, from ``ev``."""
    given = EVENT_MESSAGES[kind]
    kinds = {"string": "VARCHAR", "int": "INTEGER", S.MONEY: "DECIMAL(18,4)"}
    fields = ", ".join(
        f"CAST(coalesce({given[f.source]}, '{f.missing}') AS {kinds[f.type]}) AS {f.name}"
        for f in S.FIELDS[kind]
    )
    return f"""{name or kind} AS (
    SELECT * FROM (
        SELECT event_id, ts, {given['op']} AS op, local_day AS business_date, {fields} FROM ev) AS r
    WHERE {_KEEP_SQL[kind]})"""


def products_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as OTC products, in two daily snapshots."""
    part = load(spark, sf_dir, "part")
    newest = part.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") <= 25, F.lit(1000056)).otherwise(1000001).cast("bigint").alias("fxjg"),
        F.when(F.col("p_type").isin("ECONOMY", "LARGE", "PROMO"), F.lit(511))
        .otherwise(509)
        .cast("bigint")
        .alias("cplx"),
        F.lit("202401").alias("month_id"),
        F.lit("02").alias("day_id"),
    )
    older = newest.withColumns({"cplx": F.lit(0).cast("bigint"), "day_id": F.lit("01")})
    return newest.unionByName(older)


PRODUCTS_SQL = """products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS prod_id,
           CASE WHEN p_size <= 25 THEN '1000056' ELSE '1000001' END AS issuer,
           CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'PROMO') THEN '511' ELSE '509' END AS prod_type
    FROM part)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:

    return latest_products(products_history(spark, sf_dir))
