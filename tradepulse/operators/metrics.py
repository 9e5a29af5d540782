"""Metric families. Amounts are summed per currency first, then converted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E
from tradepulse.operators.enrich import attach_products

DAY = ("business_date",)
TRADE_KEYS = ("business_date", "branch", "channel")


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def totals_by_currency(
    df: DataFrame,
    rates: DataFrame,
    by: Sequence[str],
    counts: Mapping[str, Column],
    amounts: Mapping[str, Column],
    plain: Mapping[str, Column] | None = None,
    currency: str = "currency",
) -> DataFrame:
    """Counts and converted sums per ``by``.

    Rows are summed per currency within each task; only those sums meet the
    rate table and are converted. ``plain`` sums are not converted.
    """
    plain = plain or {}
    per_currency = df.groupBy(*by, E.currency_key(currency).alias("_currency")).agg(
        *[c.alias(n) for n, c in counts.items()],
        *[F.sum(c).alias(n) for n, c in amounts.items()],
        *[F.sum(c).alias(n) for n, c in plain.items()],
    )
    priced = per_currency.join(
        rates.select(F.col("currency").alias("_currency"), "rate"), "_currency", "left"
    )
    return priced.groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in counts],
        *[F.sum(E.converted_sum(n)).cast(S.CONVERTED).alias(n) for n in amounts],
        *[F.sum(n).cast("decimal(38,4)").alias(n) for n in plain],
    )


def order_metrics(
    orders: DataFrame, rates: DataFrame, by: Sequence[str] = TRADE_KEYS
) -> DataFrame:
    """Orders entered: count, margin and security-group counts, value."""
    group = E.security_group("sec_class")
    return totals_by_currency(
        orders,
        rates,
        by,
        counts={
            "entr_tims": F.count(F.lit(1)),
            "marg_entr_tims": count_if(E.is_margin_order("cancel_flag", "settle_type")),
            "stoc_entr_tims": count_if(group == "stock"),
            "fund_entr_tims": count_if(group == "fund"),
            "bond_entr_tims": count_if(group == "bond"),
        },
        amounts={"entr_amt": E.order_value("qty", "price")},
    )


def fill_metrics(
    fills: DataFrame,
    rates: DataFrame,
    by: Sequence[str] = TRADE_KEYS,
    margin_prefixes: Sequence[str] = E.MARGIN_PREFIXES,
    margin: bool = True,
) -> DataFrame:
    """Fills: count, amount, margin amount, and commission (not converted)."""
    amounts = {"mtch_amt": F.col("fill_amt")}
    if margin:
        amounts["marg_mtch_amt"] = F.when(
            E.is_margin_fill("holder_acct", margin_prefixes), F.col("fill_amt")
        ).otherwise(F.lit(0).cast(S.MONEY))
    return totals_by_currency(
        fills,
        rates,
        by,
        counts={"mtch_tims": F.count(F.lit(1))},
        amounts=amounts,
        plain={"tot_cms": F.col("commission")},
    )


TRADE_MEASURES = {
    "entr_tims": "bigint",
    "entr_amt": S.CONVERTED,
    "marg_entr_tims": "bigint",
    "stoc_entr_tims": "bigint",
    "fund_entr_tims": "bigint",
    "bond_entr_tims": "bigint",
    "mtch_tims": "bigint",
    "mtch_amt": S.CONVERTED,
    "tot_cms": "decimal(38,4)",
    "marg_mtch_amt": S.CONVERTED,
}


def sum_measures(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, str] = TRADE_MEASURES
) -> DataFrame:
    """Add rows up per key; a measure a row or the whole frame lacks counts as zero."""
    zero = F.lit(0)
    return df.groupBy(*by).agg(
        *[
            (F.coalesce(F.sum(m), zero) if m in df.columns else zero).cast(t).alias(m)
            for m, t in measures.items()
        ]
    )


def trade_totals(
    order_part: DataFrame, fill_part: DataFrame, by: Sequence[str] = TRADE_KEYS
) -> DataFrame:
    """Both sides on one row per key, zeros where one is missing.

    A union and one sum give the full outer join in a single shuffle. Keys
    without any order or fill are left out.
    """
    both = order_part.unionByName(fill_part, allowMissingColumns=True)
    return sum_measures(both, by).where("entr_tims <> 0 OR mtch_tims <> 0")


def order_rows(orders: DataFrame, by: Sequence[str] = TRADE_KEYS) -> DataFrame:
    """Orders as narrow rows of the measures they count for."""
    group = E.security_group("sec_class")
    return orders.select(
        *by,
        E.currency_key("currency").alias("_currency"),
        F.lit(1).alias("entr_tims"),
        E.is_margin_order("cancel_flag", "settle_type").cast("int").alias("marg_entr_tims"),
        *[(group == kind).cast("int").alias(f"{short}_entr_tims") for kind, short in (("stock", "stoc"), ("fund", "fund"), ("bond", "bond"))],
        E.order_value("qty", "price").alias("entr_amt"),
    )


def fill_rows(
    fills: DataFrame, by: Sequence[str] = TRADE_KEYS, margin_prefixes: Sequence[str] = E.MARGIN_PREFIXES
) -> DataFrame:
    """Fills as narrow rows of the measures they count for."""
    return fills.select(
        *by,
        E.currency_key("currency").alias("_currency"),
        F.lit(1).alias("mtch_tims"),
        F.col("fill_amt").alias("mtch_amt"),
        F.when(E.is_margin_fill("holder_acct", margin_prefixes), F.col("fill_amt")).alias("marg_mtch_amt"),
        F.col("commission").alias("tot_cms"),
    )


def trade_rows(
    orders: DataFrame, fills: DataFrame, by: Sequence[str], margin_prefixes: Sequence[str] = E.MARGIN_PREFIXES
) -> DataFrame:
    """Orders and fills as narrow rows of one shape, a measure of the other side being null."""
    return order_rows(orders, by).unionByName(fill_rows(fills, by, margin_prefixes), allowMissingColumns=True)


#: Measures that are converted to the reference currency.
CONVERTED_MEASURES = ("entr_amt", "mtch_amt", "marg_mtch_amt")


def trade_totals_by_row(rows: DataFrame, rates: DataFrame, by: Sequence[str] = TRADE_KEYS) -> DataFrame:
    """Totals of :func:`trade_rows` (or of rows that have all its measures) in one aggregation.

    For keys so fine that sums per currency are hardly fewer than the rows: the rate
    meets the rows, and no second shuffle brings the currencies of a key together.
    Amount times rate keeps all decimals.
    """
    priced = rows.join(rates.select(F.col("currency").alias("_currency"), "rate"), "_currency", "left")
    return priced.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(E.converted(m) if m in CONVERTED_MEASURES else F.col(m)), F.lit(0)).cast(t).alias(m)
            for m, t in TRADE_MEASURES.items()
        ]
    )


def new_customers(
    customers: DataFrame, by: Sequence[str] = DAY, any_op: bool = False
) -> DataFrame:
    """Accounts opened today, per customer type."""
    rows = customers.where((F.col("cust_type") != "") & (F.col("open_date") == F.col("business_date")))
    if not any_op:
        rows = rows.where(F.col("op") == S.INSERT)
    return rows.groupBy(*by, "cust_type").agg(F.count(F.lit(1)).alias("n"))


def closed_customers(
    customers: DataFrame,
    by: Sequence[str] = DAY,
    ops: Sequence[str] = (S.INSERT, S.UPDATE),
) -> DataFrame:
    """Customers closed today: status 3 and today's closing date."""
    rows = customers.where(
        F.col("op").isin(*ops)
        & E.same_text("cust_status", "3")
        & (F.col("close_date") == F.col("business_date").cast("string"))
    )
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def cash_flow(cash: DataFrame, rates: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Converted capital moved in and out."""
    return totals_by_currency(
        cash, rates, (*by, "direction"), counts={"n": F.count(F.lit(1))}, amounts={"amount": F.col("amount")}
    )


def count_rows(df: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Account openings and the like: every message counts."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def request_deals(inserts: DataFrame, by: Sequence[str] = (*DAY, "branch")) -> DataFrame:
    """Branch requests entered as done (status 8)."""
    return count_rows(inserts.where(E.same_text("proc_status", "8")), by)


def request_update_candidates(updates: DataFrame) -> DataFrame:
    """Updates that could count once matched."""
    return updates.where(E.same_text("proc_status", "8"))


def is_request_deal() -> Column:
    """A matched update counts when its request was entered today."""
    return F.col("matched") & (F.col("request_date") == F.col("business_date"))


# Fixed values of the OTC products that are counted.
CURRENCY_PRODUCT = {"biz_code": "22", "proc_status": "0", "prod_class": "5", "issuer": "1000056"}
CURRENCY_TYPE, OTHER_TYPE = "511", "509"
INSURANCE_CLASS = "14"


def otc_insert_outcomes(
    inserts: DataFrame, products: DataFrame, by: Sequence[str] = DAY
) -> DataFrame:
    """OTC requests that count on entry, as (by…, metric, n, biz_amt).

    Metrics are crrc, not_crrc, ins and otc_acc; a request can count under two.
    Requests alike in all tested fields are added up first, so a product that
    most requests are for reaches the product join as a few rows.
    """
    tested = ("prod_id", "biz_code", "proc_status", "proc_result", "prod_class")
    alike = inserts.groupBy(*by, *tested).agg(
        F.count(F.lit(1)).alias("n"), F.sum("biz_amt").alias("biz_amt")
    )
    rows = attach_products(alike, products)
    product = (
        ~E.same_text("prod_id", S.ABSENT)
        & E.same_text("biz_code", CURRENCY_PRODUCT["biz_code"])
        & E.same_text("proc_status", CURRENCY_PRODUCT["proc_status"])
        & (F.col("prod_class") == CURRENCY_PRODUCT["prod_class"])
        & (F.col("issuer") == CURRENCY_PRODUCT["issuer"])
    )
    done = E.same_text("proc_status", "2") & (F.col("proc_result") == "1")
    insurance = ~E.same_text("biz_code", "001") & done & (F.col("prod_class") == INSURANCE_CLASS)
    opened = done & E.same_text("biz_code", "1")
    metrics = F.array(
        F.when(product & (F.col("prod_type") == CURRENCY_TYPE), "crrc"),
        F.when(product & (F.col("prod_type") == OTHER_TYPE), "not_crrc"),
        F.when(insurance, "ins"),
        F.when(opened, "otc_acc"),
    )
    return rows.select(*by, F.explode(F.array_compact(metrics)).alias("metric"), "n", "biz_amt")


def otc_update_outcomes(enriched: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Enriched OTC updates that count, in the same form."""
    rows = enriched.select(*by, otc_update_outcome().alias("metric"), F.lit(1).alias("n"), "biz_amt")
    return rows.where(F.col("metric").isNotNull())


def otc_update_candidates(updates: DataFrame) -> DataFrame:
    return updates.where(E.same_text("proc_status", "2"))


def otc_update_outcome() -> Column:
    """What an enriched OTC update counts as; null when it does not count."""
    done = E.same_text("proc_result", "1")
    opened = E.same_text("biz_code", "1")
    insurance = E.same_text("prod_class", INSURANCE_CLASS)
    return F.when(opened & done, "otc_acc").when(~opened & done & insurance, "ins")


def outcome_totals(outcomes: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Count and amount per outcome; account openings carry no amount."""
    amount = F.when(F.col("metric") == "otc_acc", F.lit(0).cast(S.MONEY)).otherwise(F.col("biz_amt"))
    return outcomes.groupBy(*by, "metric").agg(
        F.sum("n").cast("bigint").alias("n"), F.sum(amount).cast(S.CONVERTED).alias("amount")
    )


def otc_processed(otc: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Older variant: OTC requests of any operation with status 2."""
    return count_rows(otc.where(E.same_text("proc_status", "2")), by)


# Activity rows: every daily metric that is not a trade, in one long table
# (business_date, branch, metric, n, amount).
ACTIVITY_KEYS = ("business_date", "branch", "metric")
ACTIVITY_MEASURES = {"n": "bigint", "amount": S.CONVERTED}


def activity(
    df: DataFrame,
    metric: Column | str,
    amount: Column | None = None,
    branch: Column | None = None,
    n: Column | str = "n",
) -> DataFrame:
    """A metric frame in activity form."""
    return df.select(
        "business_date",
        (F.lit("") if branch is None else branch).alias("branch"),
        (F.lit(metric) if isinstance(metric, str) else metric).alias("metric"),
        (F.col(n) if isinstance(n, str) else n).cast("bigint").alias("n"),
        (F.lit(0) if amount is None else amount).cast(S.CONVERTED).alias("amount"),
    )


def activity_totals(rows: DataFrame) -> DataFrame:
    return sum_measures(rows, ACTIVITY_KEYS, ACTIVITY_MEASURES)


def _picked(measure: str, *metrics: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("metric").isin(*metrics), F.col(measure))), F.lit(0))


def customer_day_stats(rows: DataFrame) -> DataFrame:
    """One row per day of customer and capital metrics; idle days are left out."""
    # Column names of the result table.
    counts = {
        "new_ins_nums": "new_jg",
        "new_indv_nums": "new_gr",
        "stk_acc_nums": "stock_account",
        "fnd_acc_nums": "fund_account",
        "bnk_acc_nums": "bank_account",
        "clos_cust_nums": "closed",
        "otc_acc_nums": "otc_acc",
    }
    sums = {"accm_cap_in": f"cash_{S.CASH_IN}", "accm_cap_out": f"cash_{S.CASH_OUT}"}
    wide = rows.groupBy(F.col("business_date").alias("date_id")).agg(
        *[_picked("n", m).cast("bigint").alias(c) for c, m in counts.items()],
        *[_picked("amount", m).cast(S.CONVERTED).alias(c) for c, m in sums.items()],
    )
    busy = F.lit(False)
    for name in (*counts, *sums):
        busy = busy | (F.col(name) != 0)
    return wide.where(busy)


def otc_day_stats(rows: DataFrame) -> DataFrame:
    """One row per day of OTC sales; written even when all are zero."""
    kinds = ("ins", "crrc", "not_crrc")
    return rows.groupBy(F.col("business_date").alias("date_id")).agg(
        *[_picked("n", k).cast("bigint").alias(f"{k}_entr_tims") for k in kinds],
        *[_picked("amount", k).cast(S.CONVERTED).alias(f"{k}_mtch_amt") for k in kinds],
    )


def branch_day_stats(rows: DataFrame) -> DataFrame:
    """Branch deals per day, zero rows left out."""
    return (
        rows.where("metric = 'deal'")
        .groupBy(F.col("business_date").alias("date_id"), F.col("branch").alias("yyb"))
        .agg(F.sum("n").cast("bigint").alias("otc_deal_count"))
        .where("otc_deal_count <> 0")
    )
