"""Catalogue: orders, fills, classification, conversion, distinct customers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E
from tradepulse.functions.rules import classify, classify_by_table
from tradepulse.operators import customers as C
from tradepulse.operators import dedup as D
from tradepulse.operators import enrich as J
from tradepulse.operators import metrics as M
from tradepulse.plans import tables as T
from tradepulse.session import work_folder
from tradepulse.sources.dimensions import latest_rates, latest_snapshot, next_trade_day
from tradepulse.sources.rules import read_rules, rule_table
from tradepulse.sources.state import lookup_bucketed, lookup_state, write_bucketed

BY = ("branch", "channel")


def orders_by_branch_channel(spark: SparkSession, sf: str) -> DataFrame:
    return M.order_metrics(T.orders_view(spark, sf), T.rates(spark), BY)


_ORDER_MEASURES_SQL = """count(*) AS entr_tims,
    count(*) FILTER (WHERE cancel_flag = 'O' AND settle_type = '5') AS marg_entr_tims,
    count(*) FILTER (WHERE sec_class LIKE 'A%' OR sec_class LIKE 'F%' OR sec_class LIKE 'C%' OR sec_class LIKE 'R%' OR sec_class LIKE 'N%') AS stoc_entr_tims,
    count(*) FILTER (WHERE sec_class LIKE 'E%' OR sec_class LIKE 'J%' OR sec_class LIKE 'L%' OR sec_class LIKE 'T%') AS fund_entr_tims,
    count(*) FILTER (WHERE sec_class LIKE 'H%' OR sec_class LIKE 'Z%') AS bond_entr_tims,
    CAST(sum(CAST(CAST(price AS DECIMAL(20,4)) * coalesce(rate, 1) AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS entr_amt"""

ORDER_STATS_SQL = f"""
    SELECT {{by}}, {_ORDER_MEASURES_SQL}
    FROM ord LEFT JOIN rates USING (currency) GROUP BY ALL"""


_FILL_MEASURES_SQL = """count(*) AS mtch_tims,
    CAST(sum(CAST(CAST(fill_amt AS DECIMAL(20,4)) * coalesce(rate, 1) AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS mtch_amt,
    CAST(sum(CASE WHEN holder_acct LIKE 'R%' THEN CAST(CAST(fill_amt AS DECIMAL(20,4)) * coalesce(rate, 1) AS DECIMAL(38,12)) ELSE 0 END) AS DECIMAL(38,12)) AS marg_mtch_amt,
    CAST(sum(commission) AS DECIMAL(38,4)) AS tot_cms"""

MATCHED_SQL = """mat AS (
    SELECT fil.*, coalesce(book.channel, 'undefine') AS channel, book.order_id IS NOT NULL AS matched
    FROM fil LEFT JOIN book USING (order_id))"""

FILL_STATS_SQL = f"""
    SELECT {{by}}, {_FILL_MEASURES_SQL}
    FROM mat LEFT JOIN rates USING (currency) GROUP BY ALL"""


def classify_channel_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Classes from a rule file, by the CASE and by the rule table."""
    path = work_folder(spark, "rules") + "/desk_channel"
    spark.createDataFrame([(json.dumps(T.DESK_RULES),)], "value STRING").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    orders = T.load(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("entry_mode"), F.col("o_orderpriority").alias("entry_operator")
    )
    by_case = orders.withColumn("channel", classify(read_rules(spark, path)))
    table = rule_table(spark, path, "desk_channel")
    both = classify_by_table(by_case, table, ["entry_mode", "entry_operator"], out="by_table")
    return both.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"),
        M.count_if(F.col("channel") == F.col("by_table")).alias("n_same_by_table"),
    )


RULE_FIELDS = ("customer", "status")


def _customer_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A rule for each customer; they all share the values of their other field."""
    customer = T.load(spark, sf, "customer")
    asked = F.array(
        F.struct(F.lit("customer").alias("field"), F.array(F.col("c_custkey").cast("string")).alias("allowed")),
        F.struct(F.lit("status").alias("field"), F.array(F.lit("O"), F.lit("F")).alias("allowed")),
    )
    return customer.select(
        F.col("c_mktsegment").alias("class"), F.col("c_custkey").alias("rule_id"), F.lit(2).alias("n_fields"), F.explode(asked).alias("own")
    ).select("class", "rule_id", "n_fields", "own.*")


def classify_long_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by the rule of their customer, of as many rules as there are customers."""
    orders = T.load(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderstatus").alias("status"))
    classified = classify_by_table(orders, _customer_rules(spark, sf), RULE_FIELDS)
    return classified.groupBy("channel", "status").agg(F.count(F.lit(1)).alias("n"))


def security_group_counts(spark: SparkSession, sf: str) -> DataFrame:
    part = T.load(spark, sf, "part").select("p_partkey", "p_type", F.upper("p_name").alias("code"))
    sold = T.load(spark, sf, "lineitem").select("l_partkey").join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    return sold.groupBy(
        F.coalesce(E.security_group("p_type"), F.lit("none")).alias("type_group"),
        F.coalesce(E.security_group("code"), F.lit("none")).alias("name_group"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _group_sql(column: str) -> str:
    def any_of(letters: str) -> str:
        return " OR ".join(f"{column} LIKE '{x}%'" for x in letters)

    return f"""CASE WHEN {any_of('HZ')} OR upper({column}) = 'A9' THEN 'bond'
        WHEN {any_of('EJLT')} THEN 'fund'
        WHEN {any_of('AFCRN')} OR upper({column}) = 'G0' THEN 'stock' ELSE 'none' END"""


def order_values(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity x price x rate per line, summed by currency."""
    lines = T.load(spark, sf, "lineitem").join(
        T.load(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    lines = lines.join(T.branches(spark, sf), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "currency", F.col("l_quantity").cast("int").alias("qty"), F.col("l_extendedprice").alias("price")
    )
    return M.totals_by_currency(
        lines,
        T.rates(spark),
        ("currency",),
        counts={"n": F.count(F.lit(1))},
        amounts={"entr_amt": E.order_value("qty", "price")},
    )


def margin_fill_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Margin amounts by holder account, here the part type (ECONOMY starts with E)."""
    part = T.load(spark, sf, "part").select("p_partkey", "p_type")
    lines = T.load(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    amount = F.col("l_extendedprice").cast(S.MONEY)
    return lines.groupBy("l_linestatus").agg(
        M.count_if(E.is_margin_fill("p_type")).alias("n_margin"),
        F.sum(F.when(E.is_margin_fill("p_type"), amount).otherwise(0))
        .cast("decimal(38,4)")
        .alias("margin_amt"),
    )


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return J.match_fills(T.fills_view(spark, sf), T.order_book(spark, sf))


def fills_by_branch_channel(spark: SparkSession, sf: str) -> DataFrame:
    return M.fill_metrics(_matched(spark, sf), T.rates(spark), BY, T.MARGIN_FLAG)


def fills_matched_heavy(spark: SparkSession, sf: str) -> DataFrame:
    """Half of all lines as fills of one order; its share of a task is bounded."""
    lines = T.load(spark, sf, "lineitem").select(
        F.when(F.col("l_partkey") % 2 == 0, F.lit(1).cast("long")).otherwise(F.col("l_orderkey")).alias("order_id"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    )
    matched = J.match_heavy_fills(lines, T.order_book(spark, sf), heavy=10_000)
    return matched.groupBy("channel", "matched").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast(S.MONEY)).cast("decimal(38,4)").alias("amount")
    )


def fills_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    fills = T.load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("fill_id"),
        F.col("l_suppkey").alias("suppkey"),
    )
    return J.without_match(fills, T.order_book(spark, sf), ["order_id"])


def _fill_keys(spark: SparkSession, sf: str) -> DataFrame:
    return T.load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"))


def _order_keys(spark: SparkSession, sf: str, status: str) -> DataFrame:
    orders = T.load(spark, sf, "orders").where(F.col("o_orderstatus") == status)
    return orders.select(F.col("o_orderkey").alias("order_id"))


def fills_matched_keys(spark: SparkSession, sf: str) -> DataFrame:
    return J.matched_keys(_fill_keys(spark, sf), T.order_book(spark, sf), ["order_id"])


def lookup_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders are this batch's INSERTs, filled ones its UPDATEs."""
    return J.lookup_keys(
        _fill_keys(spark, sf),
        _order_keys(spark, sf, "F"),
        _order_keys(spark, sf, "O"),
        ["order_id"],
    )


def state_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Order state rows that returned lines ask for."""
    orders = T.load(spark, sf, "orders")
    state = orders.select(
        F.col("o_orderkey").alias("order_id"), T.channel().alias("channel"), F.col("o_orderdate").alias("seen")
    )
    wanted = T.load(spark, sf, "lineitem").where("l_returnflag = 'R'")
    keys = wanted.select(F.col("l_orderkey").alias("order_id"))
    found = lookup_state(state, keys, ["order_id"], [F.col("seen").desc()])
    return found.select("order_id", "channel")


def state_lookup_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same from state that is stored in buckets of its key and stays there."""
    path = work_folder(spark, "state")
    orders = T.load(spark, sf, "orders")
    state = orders.select(F.col("o_orderkey").alias("order_id"), T.channel().alias("channel"))
    table = "tradepulse_" + path.rsplit("-", 1)[1]
    write_bucketed(state, table, path, "order_id", 8)
    wanted = T.load(spark, sf, "lineitem").where("l_returnflag = 'R'")
    keys = wanted.select(F.col("l_orderkey").alias("order_id"))
    return lookup_bucketed(spark.table(table), keys, "order_id")


def trade_stat_daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = M.trade_rows(T.orders_view(spark, sf), _matched(spark, sf), M.TRADE_KEYS, T.MARGIN_FLAG)
    totals = M.trade_totals_by_row(rows, T.rates(spark))
    return totals.withColumnsRenamed(
        {"business_date": "date_id", "branch": "dept", "channel": "trd_chn"}
    )


def order_customers_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    bits = C.customer_bitmaps(T.orders_view(spark, sf), BY, start=T.NAME_ORDINAL)
    return C.bitmap_counts(C.merge_bitmaps(bits, BY), BY, "entr_cust_nums")


def order_customers_words(spark: SparkSession, sf: str) -> DataFrame:
    """Customer sets of two halves of the orders, merged and counted."""
    orders = T.orders_view(spark, sf)
    halves = [C.customer_words(orders.where(f"{half} (price > 150000)"), BY, start=T.NAME_ORDINAL) for half in ("", "NOT")]
    return C.word_counts(C.merge_words(halves[0].unionByName(halves[1]), BY), BY, "entr_cust_nums")


def fill_customers_words(spark: SparkSession, sf: str) -> DataFrame:
    words = C.customer_words(_matched(spark, sf), BY, start=T.NAME_ORDINAL)
    return C.word_counts(words, BY, "mtch_cust_nums")


def fill_customers_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    bits = C.customer_bitmaps(_matched(spark, sf), BY, start=T.NAME_ORDINAL)
    return C.bitmap_counts(C.merge_bitmaps(bits, BY), BY, "mtch_cust_nums")


def customer_counts_merged(spark: SparkSession, sf: str) -> DataFrame:
    return C.customer_counts(
        T.orders_view(spark, sf), _matched(spark, sf), BY, start=T.NAME_ORDINAL
    )


def customer_ordinals(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinals of whole and of too short or unnumbered names."""
    name = F.col("c_name")
    customer = T.load(spark, sf, "customer").select(
        "c_custkey",
        E.customer_ordinal(name, T.NAME_ORDINAL).alias("ordinal"),
        E.customer_ordinal(F.substring(name, 1, 9), T.NAME_ORDINAL).alias("short_ordinal"),
        E.bad_customer_id("c_mktsegment").alias("bad_segment"),
    )
    return customer


def dedup_fills_last(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as fills of which two of an order share an id, so that ids repeat."""
    lines = T.load(spark, sf, "lineitem").select(
        F.lit(T.ONE_DAY).alias("business_date"),
        F.col("l_orderkey").alias("order_id"),
        F.expr("cast(l_linenumber div 2 as int)").alias("fill_id"),
        F.col("l_shipdate").alias("event_ts"),
        F.col("l_partkey").alias("src_offset"),
        "l_suppkey",
        F.col("l_extendedprice").cast(S.MONEY).alias("l_extendedprice"),
    )
    return D.dedup_fills(lines)


def dedup_orders_last(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer as entries of one order id, so that ids repeat."""
    orders = T.load(spark, sf, "orders").select(
        F.lit(T.ONE_DAY).alias("business_date"),
        F.col("o_custkey").alias("order_id"),
        F.col("o_orderdate").alias("event_ts"),
        F.col("o_orderkey").alias("src_offset"),
        "o_orderstatus",
    )
    return D.dedup_orders(orders)


def fills_legacy(spark: SparkSession, sf: str) -> DataFrame:
    """Older variant: no retry and no margin amount; only live (O) lines."""
    fills = T.fills_view(spark, sf).where(E.same_text("cancel_flag", "o"))
    matched = J.match_fills(fills, T.order_book(spark, sf))
    return M.fill_metrics(matched, T.rates(spark), BY, margin=False)


def order_updates_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Older variant: order updates (filled lines' orders) enriched from the INSERT."""
    inserts = T.orders_view(spark, sf).where("entry_mode <> 'P'")
    updates = T.load(spark, sf, "orders").where("o_orderstatus <> 'O'")
    updates = updates.select(F.col("o_orderkey").alias("order_id"))
    kept = J.enrich_order_updates(updates, inserts, outer=True)
    return M.totals_by_currency(
        kept,
        T.rates(spark),
        BY,
        counts={"entr_tims": F.count(F.lit(1))},
        amounts={"entr_amt": E.order_value("qty", "price")},
    )


def order_updates_matched(spark: SparkSession, sf: str) -> DataFrame:
    inserts = T.orders_view(spark, sf).where("entry_mode <> 'P'")
    updates = T.load(spark, sf, "orders").where("o_orderstatus <> 'O'")
    updates = updates.select(F.col("o_orderkey").alias("order_id"))
    kept = J.enrich_order_updates(updates, inserts)
    return kept.select("order_id", "customer_id", "branch", "channel", "price")


def latest_rate_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Rates per event type and day; only the newest day survives."""
    events = T.load(spark, sf, "events")
    history = events.groupBy(
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")).alias("bz"),
        F.date_format("ts", "yyyyMM").alias("month_id"),
        F.date_format("ts", "dd").alias("day_id"),
    ).agg(F.max("value").alias("gsbl"))
    return latest_rates(history)


def otc_products_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return T.products(spark, sf)


def snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the newest day of a larger table."""
    lines = T.load(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMM").alias("month_id"),
        F.date_format("o_orderdate", "dd").alias("day_id"),
    )
    return latest_snapshot(lines)


TRADE_CALENDAR_DAY = 19980615


def next_trade_day_of(spark: SparkSession, sf: str) -> DataFrame:
    calendar = T.load(spark, sf, "orders").select(E.day_int("o_orderdate").alias("jyr"))
    return next_trade_day(calendar, TRADE_CALENDAR_DAY)


def string_scalars(spark: SparkSession, sf: str) -> DataFrame:
    part = T.load(spark, sf, "part")
    name = F.col("p_name")
    return part.select(
        "p_partkey",
        F.upper(name).alias("upper_name"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.substring(name, 5, 3).alias("middle"),
        F.startswith(name, F.lit("blue")).alias("is_blue"),
        E.same_text("p_type", "promo").alias("is_promo"),
        F.reverse(name).alias("reversed"),
        F.element_at(F.split(name, " "), 2).alias("noun"),
        F.replace(name, F.lit("ring"), F.lit("band")).alias("replaced"),
        F.contains(name, F.lit("bolt")).alias("has_bolt"),
    )


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts)


QUERIES = {
    "orders_by_branch_channel": (
        orders_by_branch_channel,
        _with(T.ORDERS_SQL, T.RATES_SQL) + ORDER_STATS_SQL.format(by="branch, channel"),
    ),
    "classify_channel_counts": (
        classify_channel_counts,
        f"SELECT {T.CHANNEL_SQL} AS channel, count(*) AS n, count(*) AS n_same_by_table FROM orders GROUP BY 1",
    ),
    "security_group_counts": (
        security_group_counts,
        f"""WITH sold AS (SELECT p_type, upper(p_name) AS code FROM lineitem JOIN part ON l_partkey = p_partkey)
        SELECT {_group_sql('p_type')} AS type_group, {_group_sql('code')} AS name_group, count(*) AS n
        FROM sold GROUP BY 1, 2""",
    ),
    "order_values": (
        order_values,
        _with(T.RATES_SQL)
        + """ SELECT r_name AS currency, count(*) AS n,
        CAST(sum(CAST(CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,4)) AS DECIMAL(22,4)) * coalesce(rate, 1) AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS entr_amt
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey LEFT JOIN rates ON rates.currency = r_name GROUP BY 1""",
    ),
    "margin_fill_amounts": (
        margin_fill_amounts,
        """SELECT l_linestatus, count(*) FILTER (WHERE p_type LIKE 'E%' OR p_type LIKE '06%') AS n_margin,
        CAST(sum(CASE WHEN p_type LIKE 'E%' OR p_type LIKE '06%' THEN CAST(l_extendedprice AS DECIMAL(18,4)) ELSE 0 END) AS DECIMAL(38,4)) AS margin_amt
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    ),
    "fills_by_branch_channel": (
        fills_by_branch_channel,
        _with(T.FILLS_SQL, T.BOOK_SQL, MATCHED_SQL, T.RATES_SQL)
        + FILL_STATS_SQL.format(by="branch, channel"),
    ),
    "fills_unmatched": (
        fills_unmatched,
        """SELECT l_orderkey AS order_id, l_linenumber AS fill_id, l_suppkey AS suppkey FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
    ),
    "fills_matched_keys": (
        fills_matched_keys,
        """SELECT DISTINCT l_orderkey AS order_id FROM lineitem
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
    ),
    "lookup_keys": (
        lookup_keys,
        """(SELECT l_orderkey AS order_id FROM lineitem UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
        EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'""",
    ),
    "state_lookup": (
        state_lookup,
        f"""SELECT o_orderkey AS order_id, {T.CHANNEL_SQL} AS channel FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    ),
    "state_lookup_bucketed": (
        state_lookup_bucketed,
        f"""SELECT o_orderkey AS order_id, {T.CHANNEL_SQL} AS channel FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    ),
    "trade_stat_daily": (
        trade_stat_daily,
        _with(
            T.ORDERS_SQL,
            T.FILLS_SQL,
            T.BOOK_SQL,
            MATCHED_SQL,
            T.RATES_SQL,
            f"o AS ({ORDER_STATS_SQL.format(by='business_date, branch, channel')})",
            f"f AS ({FILL_STATS_SQL.format(by='business_date, branch, channel')})",
        )
        + """ SELECT business_date AS date_id, branch AS dept, channel AS trd_chn,
        coalesce(entr_tims, 0) AS entr_tims, coalesce(entr_amt, 0) AS entr_amt,
        coalesce(marg_entr_tims, 0) AS marg_entr_tims, coalesce(stoc_entr_tims, 0) AS stoc_entr_tims,
        coalesce(fund_entr_tims, 0) AS fund_entr_tims, coalesce(bond_entr_tims, 0) AS bond_entr_tims,
        coalesce(mtch_tims, 0) AS mtch_tims, coalesce(mtch_amt, 0) AS mtch_amt,
        coalesce(tot_cms, 0) AS tot_cms, coalesce(marg_mtch_amt, 0) AS marg_mtch_amt
        FROM o FULL JOIN f USING (business_date, branch, channel)""",
    ),
    "order_customers_bitmap": (
        order_customers_bitmap,
        _with(T.ORDERS_SQL)
        + " SELECT branch, channel, count(DISTINCT customer_id) AS entr_cust_nums FROM ord GROUP BY 1, 2",
    ),
    "order_customers_words": (
        order_customers_words,
        _with(T.ORDERS_SQL)
        + " SELECT branch, channel, count(DISTINCT customer_id) AS entr_cust_nums FROM ord GROUP BY 1, 2",
    ),
    "fill_customers_words": (
        fill_customers_words,
        _with(T.FILLS_SQL, T.BOOK_SQL, MATCHED_SQL)
        + " SELECT branch, channel, count(DISTINCT customer_id) AS mtch_cust_nums FROM mat GROUP BY 1, 2",
    ),
    "classify_long_rules": (
        classify_long_rules,
        """SELECT CASE WHEN o_orderstatus IN ('O', 'F') AND c_custkey IS NOT NULL THEN c_mktsegment ELSE 'qt' END AS channel,
        o_orderstatus AS status, count(*) AS n FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""",
    ),
    "fills_matched_heavy": (
        fills_matched_heavy,
        f"""WITH {T.BOOK_SQL}, l AS (
            SELECT CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE l_orderkey END AS order_id, CAST(l_extendedprice AS DECIMAL(18,4)) AS amount FROM lineitem)
        SELECT coalesce(book.channel, 'undefine') AS channel, book.order_id IS NOT NULL AS matched, count(*) AS n,
            CAST(sum(amount) AS DECIMAL(38,4)) AS amount
        FROM l LEFT JOIN book USING (order_id) GROUP BY 1, 2""",
    ),
    "fill_customers_bitmap": (
        fill_customers_bitmap,
        _with(T.FILLS_SQL, T.BOOK_SQL, MATCHED_SQL)
        + " SELECT branch, channel, count(DISTINCT customer_id) AS mtch_cust_nums FROM mat GROUP BY 1, 2",
    ),
    "customer_counts_merged": (
        customer_counts_merged,
        _with(
            T.ORDERS_SQL,
            T.FILLS_SQL,
            T.BOOK_SQL,
            MATCHED_SQL,
            "o AS (SELECT branch, channel, count(DISTINCT customer_id) AS n FROM ord GROUP BY 1, 2)",
            "f AS (SELECT branch, channel, count(DISTINCT customer_id) AS n FROM mat GROUP BY 1, 2)",
        )
        + """ SELECT branch, channel, coalesce(o.n, 0) AS entr_cust_nums, coalesce(f.n, 0) AS mtch_cust_nums
        FROM o FULL JOIN f USING (branch, channel)""",
    ),
    "customer_ordinals": (
        customer_ordinals,
        """SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS ordinal, CAST(NULL AS BIGINT) AS short_ordinal,
        length(c_mktsegment) > 4 AND TRY_CAST(substr(c_mktsegment, 5) AS BIGINT) IS NULL AS bad_segment FROM customer""",
    ),
    "dedup_fills_last": (
        dedup_fills_last,
        f"""SELECT {T.ONE_DAY} AS business_date, l_orderkey AS order_id, CAST(l_linenumber // 2 AS INTEGER) AS fill_id, l_shipdate AS event_ts,
        l_partkey AS src_offset, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,4)) AS l_extendedprice
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber // 2
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    ),
    "dedup_orders_last": (
        dedup_orders_last,
        f"""SELECT {T.ONE_DAY} AS business_date, o_custkey AS order_id, o_orderdate AS event_ts, o_orderkey AS src_offset, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    ),
    "fills_legacy": (
        fills_legacy,
        _with(T.FILLS_SQL, T.BOOK_SQL, MATCHED_SQL, T.RATES_SQL)
        + """ SELECT branch, channel, count(*) AS mtch_tims,
        CAST(sum(CAST(CAST(fill_amt AS DECIMAL(20,4)) * coalesce(rate, 1) AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS mtch_amt,
        CAST(sum(commission) AS DECIMAL(38,4)) AS tot_cms
        FROM mat LEFT JOIN rates USING (currency) WHERE cancel_flag = 'O' GROUP BY 1, 2""",
    ),
    "order_updates_enriched": (
        order_updates_enriched,
        _with(T.ORDERS_SQL, T.RATES_SQL)
        + """ , e AS (SELECT coalesce(i.branch, '') AS branch, coalesce(i.channel, 'qt') AS channel,
            coalesce(i.currency, '') AS currency, coalesce(i.price, 0) AS price
            FROM orders LEFT JOIN (SELECT * FROM ord WHERE entry_mode <> 'P') i ON i.order_id = o_orderkey
            WHERE o_orderstatus <> 'O')
        SELECT branch, channel, count(*) AS entr_tims,
        CAST(sum(CAST(CAST(price AS DECIMAL(20,4)) * coalesce(rate, 1) AS DECIMAL(38,12))) AS DECIMAL(38,12)) AS entr_amt
        FROM e LEFT JOIN rates USING (currency) GROUP BY 1, 2""",
    ),
    "order_updates_matched": (
        order_updates_matched,
        _with(T.ORDERS_SQL)
        + " SELECT order_id, customer_id, branch, channel, price FROM ord WHERE entry_mode = 'F'",
    ),
    "latest_rate_snapshot": (
        latest_rate_snapshot,
        """WITH h AS (SELECT upper(event_type) AS currency, strftime(ts, '%Y%m%d') AS d, max(value) AS v FROM events GROUP BY 1, 2)
        SELECT currency, CAST(v AS DECIMAL(15,8)) AS rate FROM h WHERE d = (SELECT max(d) FROM h)""",
    ),
    "otc_products_snapshot": (
        otc_products_snapshot,
        _with(T.PRODUCTS_SQL) + " SELECT prod_id, issuer, prod_type FROM products",
    ),
    "snapshot_rows": (
        snapshot_rows,
        """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month_id, strftime(o_orderdate, '%d') AS day_id
        FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
    ),
    "next_trade_day": (
        next_trade_day_of,
        f"""SELECT min(CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER)) AS next_trade_day FROM orders
        WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) > {TRADE_CALENDAR_DAY}""",
    ),
    "string_scalars": (
        string_scalars,
        """SELECT p_partkey, upper(p_name) AS upper_name, p_name AS trimmed, substr(p_name, 5, 3) AS middle,
        p_name LIKE 'blue%' AS is_blue, p_type = 'PROMO' AS is_promo, reverse(p_name) AS reversed,
        split_part(p_name, ' ', 2) AS noun, replace(p_name, 'ring', 'band') AS replaced,
        p_name LIKE '%bolt%' AS has_bolt FROM part""",
    ),
}
