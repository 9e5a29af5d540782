"""Catalogue: customers, cash, accounts, branch requests, OTC requests.

Column names of the result tables (``new_ins_nums`` and the like) are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E
from tradepulse.operators import dedup as D
from tradepulse.operators import enrich as J
from tradepulse.operators import metrics as M
from tradepulse.operators.project import split_by_op
from tradepulse.plans import tables as T

Query = Callable[[SparkSession, str], DataFrame]

DAY = ("business_date",)
ONE_DAY = 20240115


def new_customers_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return M.new_customers(T.event_records(spark, sf, "customer"))


def closed_customers(spark: SparkSession, sf: str) -> DataFrame:
    return M.closed_customers(T.event_records(spark, sf, "customer"))


def cash_flow_in_out(spark: SparkSession, sf: str) -> DataFrame:
    return M.cash_flow(T.event_records(spark, sf, "cash"), T.rates(spark))


def _opened(kind: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return M.count_rows(T.event_records(spark, sf, kind))

    return query


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return D.dedup_requests(T.event_records(spark, sf, "dept_request"))


def _request_deals(requests: DataFrame) -> DataFrame:
    """INSERT deals and matched UPDATE deals, as (day, branch, n) rows of both."""
    inserts, updates = split_by_op(requests)
    entered = M.request_deals(inserts)
    wanted = M.request_update_candidates(updates)
    wanted = wanted.drop("branch", "customer_id", "request_date")
    done = J.enrich_request_updates(wanted, inserts, ("business_date", "request_id"))
    return entered.unionByName(
        M.count_rows(done.where(M.is_request_deal()), ("business_date", "branch"))
    )


def dept_deals_by_branch(spark: SparkSession, sf: str) -> DataFrame:
    deals = _request_deals(_requests(spark, sf))
    return deals.groupBy("business_date", "branch").agg(F.sum("n").alias("n"))


def _otc(spark: SparkSession, sf: str) -> DataFrame:
    return D.dedup_otc(T.event_records(spark, sf, "otc"))


def _otc_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    inserts, updates = split_by_op(_otc(spark, sf))
    by = ("business_date", "op")
    entered = M.otc_insert_outcomes(inserts, T.products(spark, sf), by)
    filled = J.enrich_otc_updates(
        M.otc_update_candidates(updates), inserts, ("business_date", "order_id")
    )
    return entered.unionByName(M.otc_update_outcomes(filled, by))


def otc_product_stats(spark: SparkSession, sf: str) -> DataFrame:
    return M.outcome_totals(_otc_outcomes(spark, sf))


def otc_accounts_opened(spark: SparkSession, sf: str) -> DataFrame:
    opened = _otc_outcomes(spark, sf).where("metric = 'otc_acc'")
    return opened.groupBy("business_date", "op").agg(F.sum("n").alias("n"))


def otc_updates_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Every OTC update after the four fields are filled in."""
    inserts, updates = split_by_op(_otc(spark, sf))
    filled = J.enrich_otc_updates(updates, inserts, ("business_date", "order_id"))
    return filled.select(
        "business_date", "order_id", "biz_code", "proc_result", "prod_class", "biz_amt", "matched"
    )


def _activity_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers = T.event_records(spark, sf, "customer")
    flow = cash_flow_in_out(spark, sf)
    rows = M.activity(
        M.new_customers(customers), F.concat(F.lit("new_"), F.col("cust_type"))
    ).unionByName(M.activity(M.closed_customers(customers), "closed"))
    rows = rows.unionByName(
        M.activity(flow, F.concat(F.lit("cash_"), F.col("direction")), F.col("amount"))
    )
    for kind in ("stock_account", "bank_account", "fund_account"):
        rows = rows.unionByName(M.activity(_opened(kind)(spark, sf), kind))
    outcomes = otc_product_stats(spark, sf)
    return rows.unionByName(M.activity(outcomes, F.col("metric"), F.col("amount")))


def other_stat_daily(spark: SparkSession, sf: str) -> DataFrame:
    return M.customer_day_stats(_activity_rows(spark, sf))


def otc_stat_daily(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = otc_product_stats(spark, sf)
    return M.otc_day_stats(M.activity(outcomes, F.col("metric"), F.col("amount")))


def dept_stat_daily(spark: SparkSession, sf: str) -> DataFrame:
    deals = _request_deals(_requests(spark, sf))
    return M.branch_day_stats(M.activity(deals, "deal", branch=F.col("branch")))


def account_counts_no_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every stock-account message counts, repeated ones too."""
    once = T.event_records(spark, sf, "stock_account")
    twice = once.unionByName(once)
    return M.count_rows(twice, ("business_date", "holder_status"))


def customers_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return M.new_customers(T.event_records(spark, sf, "customer"), any_op=True)


def cash_legacy(spark: SparkSession, sf: str) -> DataFrame:
    """Older variant: one sum per direction."""
    flow = M.cash_flow(T.event_records(spark, sf, "cash"), T.rates(spark), by=())
    return flow.select("direction", "amount")


def request_count_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of older variants: no status test, or one operation only."""
    customers = T.event_records(spark, sf, "customer")
    requests = T.event_records(spark, sf, "dept_request")

    def named(df: DataFrame, name: str, group: str = "''") -> DataFrame:
        return df.select(F.lit(name).alias("variant"), F.expr(group).alias("grp"), "business_date", "n")

    return (
        named(M.otc_processed(T.event_records(spark, sf, "otc")), "otc_processed")
        .unionByName(
            named(M.count_rows(requests, ("business_date", "branch")), "requests", "branch")
        )
        .unionByName(named(M.closed_customers(customers, ops=(S.INSERT,)), "closed_insert"))
        .unionByName(named(M.closed_customers(customers, ops=(S.UPDATE,)), "closed_update"))
    )


def event_day_counts(spark: SparkSession, sf: str) -> DataFrame:
    micros = T.events_base(spark, sf).select(F.col("micros").cast("string").alias("jstime"))
    ts = E.source_timestamp("jstime")
    return micros.groupBy(
        E.event_day(ts).alias("local_day"), E.event_day(ts, "UTC").alias("utc_day")
    ).agg(F.count(F.lit(1)).alias("n"))


def business_day_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The day gate at one given business date."""
    rows = T.event_records(spark, sf, "bank_account", business_date=ONE_DAY)
    return rows.select("bank_acct", "customer_id", "open_date", "business_date")


def dedup_otc_last(spark: SparkSession, sf: str) -> DataFrame:
    return _otc(spark, sf).select(
        "business_date", "op", "order_id", F.col("src_offset").alias("event_id"), "biz_amt"
    )


def dedup_requests_last(spark: SparkSession, sf: str) -> DataFrame:
    return _requests(spark, sf).select(
        "business_date", "op", "request_id", F.col("src_offset").alias("event_id"), "branch"
    )


def _newest(spark: SparkSession, sf: str, kind: str, key: str, columns: list[str]) -> DataFrame:
    inserts, _ = split_by_op(T.event_records(spark, sf, kind))
    order = [F.col("event_ts").desc(), F.col("src_offset").desc()]
    return D.last_per_key(inserts, [key], order).select(key, *columns)


def otc_state_latest(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["customer_id", "biz_code", "proc_status", "proc_result", "prod_class", "biz_amt", "reg_date", "prod_id"]
    return _newest(spark, sf, "otc", "order_id", columns)


def request_state_latest(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["customer_id", "branch", "request_date", "proc_status"]
    return _newest(spark, sf, "dept_request", "request_id", columns)


def order_state_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Order-state rows: every third order is entered again, by hand and for more."""
    view = T.orders_view(spark, sf)
    first = view.withColumns({"event_ts": F.to_timestamp_ntz(F.lit("2024-01-15 10:00:00")), "src_offset": F.col("order_id")})
    again = first.where("order_id % 3 = 0").withColumns(
        {"qty": F.lit(2), "channel": F.lit("again"), "src_offset": F.col("src_offset") + 1}
    )
    newest = D.dedup_orders(first.unionByName(again))
    return newest.select(
        "customer_id", "order_id", "branch", "currency", "channel", "qty", "price",
        "cancel_flag", "settle_type", "business_date",
    )


# -- SQL ---------------------------------------------------------------------


def _records(*kinds: str) -> str:
    return "WITH " + ", ".join([T.EVENTS_SQL, *[T.event_records_sql(k) for k in kinds]])


_LAST = "row_number() OVER (PARTITION BY business_date, op, {key} ORDER BY ts DESC, event_id DESC) = 1"
REQUESTS_SQL = f"""req AS (
    SELECT * FROM dept_request WHERE op <> 'INSERT' OR request_date = business_date
    QUALIFY {_LAST.format(key='request_id')})"""
DEALS_SQL = """deals AS (
    SELECT business_date, branch, count(*) AS n FROM req WHERE op = 'INSERT' AND proc_status = '8' GROUP BY 1, 2
    UNION ALL
    SELECT u.business_date, i.branch, count(*) FROM req u JOIN req i
      ON i.op = 'INSERT' AND i.request_id = u.request_id AND i.business_date = u.business_date
    WHERE u.op = 'UPDATE' AND u.proc_status = '8' GROUP BY 1, 2)"""
OTC_SQL = f"""lst AS (SELECT * FROM otc QUALIFY {_LAST.format(key='order_id')}),
filled AS (
    SELECT u.business_date, u.order_id, u.proc_status,
        CASE WHEN u.biz_code = 'nvl' THEN coalesce(i.biz_code, 'nvl') ELSE u.biz_code END AS biz_code,
        CASE WHEN u.proc_result = 'nvl' THEN coalesce(i.proc_result, 'nvl') ELSE u.proc_result END AS proc_result,
        CASE WHEN u.prod_class = 'nvl' THEN coalesce(i.prod_class, 'nvl') ELSE u.prod_class END AS prod_class,
        CASE WHEN u.biz_amt = 0 THEN coalesce(i.biz_amt, 0) ELSE u.biz_amt END AS biz_amt,
        i.order_id IS NOT NULL AS matched
    FROM (SELECT * FROM lst WHERE op = 'UPDATE') u LEFT JOIN (SELECT * FROM lst WHERE op = 'INSERT') i
    ON i.order_id = u.order_id AND i.business_date = u.business_date),
outcomes AS (
    SELECT business_date, op, 'crrc' AS metric, biz_amt FROM lst JOIN products USING (prod_id)
    WHERE op = 'INSERT' AND biz_code = '22' AND proc_status = '0' AND prod_class = '5' AND issuer = '1000056' AND prod_type = '511'
    UNION ALL SELECT business_date, op, 'not_crrc', biz_amt FROM lst JOIN products USING (prod_id)
    WHERE op = 'INSERT' AND biz_code = '22' AND proc_status = '0' AND prod_class = '5' AND issuer = '1000056' AND prod_type = '509'
    UNION ALL SELECT business_date, op, 'ins', biz_amt FROM lst
    WHERE op = 'INSERT' AND biz_code <> '001' AND proc_status = '2' AND proc_result = '1' AND prod_class = '14'
    UNION ALL SELECT business_date, op, 'otc_acc', 0 FROM lst
    WHERE op = 'INSERT' AND biz_code = '1' AND proc_status = '2' AND proc_result = '1'
    UNION ALL SELECT business_date, 'UPDATE', 'otc_acc', 0 FROM filled
    WHERE proc_status = '2' AND biz_code = '1' AND proc_result = '1'
    UNION ALL SELECT business_date, 'UPDATE', 'ins', biz_amt FROM filled
    WHERE proc_status = '2' AND biz_code <> '1' AND proc_result = '1' AND prod_class = '14')"""
OTC_WITH = f"{_records('otc')}, {T.PRODUCTS_SQL}, {OTC_SQL}"
NEW_SQL = """SELECT business_date, CASE cust_type_code WHEN 0 THEN 'gr' ELSE 'jg' END AS cust_type, count(*) AS n
    FROM customer WHERE {op} cust_type_code IN (0, 1) AND open_date = business_date GROUP BY 1, 2"""
CLOSED_SQL = """SELECT business_date, count(*) AS n FROM customer
    WHERE op IN ({ops}) AND cust_status = '3' AND close_date = CAST(business_date AS VARCHAR) GROUP BY 1"""
CASH_SQL = """cashflow AS (
    SELECT business_date, CASE subject WHEN '10113' THEN 'zjzr' ELSE 'zjzc' END AS direction,
    CAST(CAST(CASE subject WHEN '10113' THEN amt_in ELSE amt_out END AS DECIMAL(20,4)) * coalesce(rate, 1) AS DECIMAL(38,12)) AS amount
    FROM cash LEFT JOIN rates ON rates.currency = upper(trim(cash.currency)))"""
COUNT_SQL = "SELECT business_date, count(*) AS n FROM {kind} GROUP BY 1"


def _day_sum(condition: str, value: str = "n", kind: str = "BIGINT") -> str:
    return f"CAST(coalesce(sum({value}) FILTER (WHERE {condition}), 0) AS {kind})"


_WIDE = f"""SELECT business_date AS date_id,
    {_day_sum("m = 'new_jg'")} AS new_ins_nums, {_day_sum("m = 'new_gr'")} AS new_indv_nums,
    {_day_sum("m = 'zjzr'", 'amount', 'DECIMAL(38,12)')} AS accm_cap_in,
    {_day_sum("m = 'zjzc'", 'amount', 'DECIMAL(38,12)')} AS accm_cap_out,
    {_day_sum("m = 'stock'")} AS stk_acc_nums, {_day_sum("m = 'fund'")} AS fnd_acc_nums,
    {_day_sum("m = 'bank'")} AS bnk_acc_nums, {_day_sum("m = 'closed'")} AS clos_cust_nums,
    {_day_sum("m = 'otc'")} AS otc_acc_nums FROM act GROUP BY 1"""
_ACT = f"""act AS (
    SELECT business_date, 'new_' || cust_type AS m, n, 0 AS amount FROM ({NEW_SQL.format(op="op = 'INSERT' AND")})
    UNION ALL SELECT business_date, 'closed', n, 0 FROM ({CLOSED_SQL.format(ops="'INSERT', 'UPDATE'")})
    UNION ALL SELECT business_date, direction, count(*), sum(amount) FROM cashflow GROUP BY 1, 2
    UNION ALL SELECT business_date, 'stock', n, 0 FROM ({COUNT_SQL.format(kind='stock_account')})
    UNION ALL SELECT business_date, 'bank', n, 0 FROM ({COUNT_SQL.format(kind='bank_account')})
    UNION ALL SELECT business_date, 'fund', n, 0 FROM ({COUNT_SQL.format(kind='fund_account')})
    UNION ALL SELECT business_date, 'otc', count(*), 0 FROM outcomes WHERE metric = 'otc_acc' GROUP BY 1)"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "new_customers_by_type": (
        new_customers_by_type,
        f"{_records('customer')} {NEW_SQL.format(op="op = 'INSERT' AND")}",
    ),
    "closed_customers": (
        closed_customers,
        f"{_records('customer')} {CLOSED_SQL.format(ops="'INSERT', 'UPDATE'")}",
    ),
    "cash_flow_in_out": (
        cash_flow_in_out,
        f"""{_records('cash')}, {T.RATES_SQL}, {CASH_SQL}
        SELECT business_date, direction, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,12)) AS amount
        FROM cashflow GROUP BY 1, 2""",
    ),
    "stock_accounts": (
        _opened("stock_account"),
        f"{_records('stock_account')} {COUNT_SQL.format(kind='stock_account')}",
    ),
    "bank_accounts": (
        _opened("bank_account"),
        f"{_records('bank_account')} {COUNT_SQL.format(kind='bank_account')}",
    ),
    "fund_accounts": (
        _opened("fund_account"),
        f"{_records('fund_account')} {COUNT_SQL.format(kind='fund_account')}",
    ),
    "dept_deals_by_branch": (
        dept_deals_by_branch,
        f"""{_records('dept_request')}, {REQUESTS_SQL}, {DEALS_SQL}
        SELECT business_date, branch, CAST(sum(n) AS BIGINT) AS n FROM deals GROUP BY 1, 2""",
    ),
    "otc_product_stats": (
        otc_product_stats,
        f"""{OTC_WITH} SELECT business_date, metric, count(*) AS n, CAST(sum(biz_amt) AS DECIMAL(38,12)) AS amount
        FROM outcomes GROUP BY 1, 2""",
    ),
    "otc_accounts_opened": (
        otc_accounts_opened,
        f"{OTC_WITH} SELECT business_date, op, count(*) AS n FROM outcomes WHERE metric = 'otc_acc' GROUP BY 1, 2",
    ),
    "otc_updates_filled": (
        otc_updates_filled,
        f"{OTC_WITH} SELECT business_date, order_id, biz_code, proc_result, prod_class, biz_amt, matched FROM filled",
    ),
    "other_stat_daily": (
        other_stat_daily,
        f"""{_records('otc', 'customer', 'cash', 'stock_account', 'bank_account', 'fund_account')},
        {T.PRODUCTS_SQL}, {OTC_SQL}, {T.RATES_SQL}, {CASH_SQL}, {_ACT} {_WIDE}""",
    ),
    "otc_stat_daily": (
        otc_stat_daily,
        f"""{OTC_WITH} SELECT business_date AS date_id, {', '.join(
            f"count(*) FILTER (WHERE metric = '{k}') AS {k}_entr_tims, "
            f"CAST(coalesce(sum(biz_amt) FILTER (WHERE metric = '{k}'), 0) AS DECIMAL(38,12)) AS {k}_mtch_amt"
            for k in ('ins', 'crrc', 'not_crrc'))} FROM outcomes GROUP BY 1""",
    ),
    "dept_stat_daily": (
        dept_stat_daily,
        f"""{_records('dept_request')}, {REQUESTS_SQL}, {DEALS_SQL}
        SELECT business_date AS date_id, branch AS yyb, CAST(sum(n) AS BIGINT) AS otc_deal_count FROM deals GROUP BY 1, 2""",
    ),
    "account_counts_no_dedup": (
        account_counts_no_dedup,
        f"{_records('stock_account')} SELECT business_date, holder_status, 2 * count(*) AS n FROM stock_account GROUP BY 1, 2",
    ),
    "customers_legacy": (customers_legacy, f"{_records('customer')} {NEW_SQL.format(op='')}"),
    "cash_legacy": (
        cash_legacy,
        f"""{_records('cash')}, {T.RATES_SQL}, {CASH_SQL}
        SELECT direction, CAST(sum(amount) AS DECIMAL(38,12)) AS amount FROM cashflow GROUP BY 1""",
    ),
    "request_count_variants": (
        request_count_variants,
        f"""{_records('otc', 'customer', 'dept_request')}
        SELECT 'otc_processed' AS variant, '' AS grp, business_date, count(*) AS n FROM otc WHERE proc_status = '2' GROUP BY 3
        UNION ALL SELECT 'requests', branch, business_date, count(*) FROM dept_request GROUP BY 2, 3
        UNION ALL SELECT 'closed_insert', '', * FROM ({CLOSED_SQL.format(ops="'INSERT'")})
        UNION ALL SELECT 'closed_update', '', * FROM ({CLOSED_SQL.format(ops="'UPDATE'")})""",
    ),
    "event_day_counts": (
        event_day_counts,
        f"WITH {T.EVENTS_SQL} SELECT local_day, utc_day, count(*) AS n FROM ev GROUP BY 1, 2",
    ),
    "business_day_filter": (
        business_day_filter,
        f"""WITH {T.EVENTS_SQL.replace('AS local_day', 'AS own_day')},
        {T.event_records_sql('bank_account').replace('local_day', str(ONE_DAY))}
        SELECT bank_acct, customer_id, open_date, business_date FROM bank_account""",
    ),
    "dedup_otc_last": (
        dedup_otc_last,
        f"""{_records('otc')} SELECT business_date, op, order_id, event_id, biz_amt FROM otc
        QUALIFY {_LAST.format(key='order_id')}""",
    ),
    "dedup_requests_last": (
        dedup_requests_last,
        f"""{_records('dept_request')}, {REQUESTS_SQL}
        SELECT business_date, op, request_id, event_id, branch FROM req""",
    ),
    "otc_state_latest": (
        otc_state_latest,
        f"""{_records('otc')} SELECT order_id, customer_id, biz_code, proc_status, proc_result, prod_class, biz_amt, reg_date, prod_id
        FROM otc WHERE op = 'INSERT' QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "request_state_latest": (
        request_state_latest,
        f"""{_records('dept_request')} SELECT request_id, customer_id, branch, request_date, proc_status
        FROM dept_request WHERE op = 'INSERT' QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "order_state_latest": (
        order_state_latest,
        f"""WITH {T.ORDERS_SQL} SELECT customer_id, order_id, branch, currency, CASE WHEN order_id % 3 = 0 THEN 'again' ELSE channel END AS channel,
        CASE WHEN order_id % 3 = 0 THEN 2 ELSE 1 END AS qty, price, cancel_flag, settle_type, business_date
        FROM ord QUALIFY row_number() OVER (PARTITION BY business_date, order_id ORDER BY price DESC) = 1""",
    ),
}
