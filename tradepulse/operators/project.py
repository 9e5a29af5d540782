"""Parsed envelopes to typed records, one frame per kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E
from tradepulse.functions.rules import Rules, classify
from tradepulse.operators.ingest import ORIGIN, route

BAD_NUMBER = "bad_number"
NULL_FIELD = "null_field"
BAD_CUSTOMER = "bad_customer_id"
BAD_ORDER = "bad_order_id"
TOO_LARGE = "too_large"
TOO_PRECISE = "too_precise"



def _text(field: S.Field, keys: str) -> str:
    """Field text with absent key and JSON null told apart.

    The struct holds null for both. Only then, and only where the two mean
    different things, are the keys of the message looked at.
    """
    found = f"after.`{field.source}`"
    if field.null_as == field.missing:
        return f"coalesce({found}, '{field.missing}')"
    null_as = "NULL" if field.null_as is None else f"'{field.null_as}'"
    return (
        f"CASE WHEN {found} IS NOT NULL THEN {found} "
        f"WHEN array_contains({keys}, '{field.source}') THEN {null_as} "
        f"ELSE '{field.missing}' END"
    )


def _typed(field: S.Field) -> str:
    """Name of a number before its reject reason is known."""
    return field.name if field.type == "string" else f"_{field.name}"


def _loses_decimals(field: S.Field) -> str:
    """More decimals than an amount keeps; the text is cast again only if it is long behind the point."""
    text = field.name
    long = f"(instr({text}, '.') > 0 AND length({text}) - instr({text}, '.') > 4) OR lower({text}) LIKE '%e%'"
    return f"(({long}) AND try_cast({text} AS DECIMAL(38,20)) <> {_typed(field)})"


def _reject_reason(kind: str) -> str:
    """Why a typed record cannot be used, as SQL; null when it can."""
    fields = S.FIELDS[kind]
    checks: list[tuple[str, str]] = []
    required = [f"{f.name} IS NULL" for f in fields if f.required]
    if required:
        insert = "" if kind in S.INSERT_ONLY_KINDS else f"op = '{S.INSERT}' AND "
        checks.append((f"{insert}({' OR '.join(required)})", NULL_FIELD))
    numbers = [f"{_typed(f)} IS NULL" for f in fields if f.type != "string"]
    if numbers:
        checks.append((" OR ".join(numbers), BAD_NUMBER))
    money = [f for f in fields if f.type == S.MONEY]
    if money:
        checks.append((" OR ".join(_loses_decimals(f) for f in money), TOO_PRECISE))
    if kind in ("order", "fill", "otc"):
        checks.append(("order_id <> '' AND try_cast(order_id AS BIGINT) IS NULL", BAD_ORDER))
    if kind in ("order", "fill"):
        checks.append((E.bad_customer_id_sql("customer_id"), BAD_CUSTOMER))
    if kind == "order":
        checks.append((f"abs(cast(_qty AS DECIMAL(10,0)) * _price) >= {S.LARGEST_VALUE}", TOO_LARGE))
    if not checks:
        return "CAST(NULL AS STRING)"
    return "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for test, name in checks) + " END"


def typed_records(
    parsed: DataFrame,
    kind: str,
    business_date: int | None = None,
    zone: str = E.DEFAULT_ZONE,
    path: str = "$.after",
) -> DataFrame:
    """Every usable message of a kind as typed fields, with ``reject_reason``.

    ``business_date`` is the day the run counts for. Left out, each message
    counts for the day of its own source time, so a replay gives the same day.
    A message without any after-image is dropped. The projection is wide, hence
    written as SQL text: one call to the driver's JVM instead of hundreds.
    """
    fields = S.FIELDS[kind]
    keys = f"json_object_keys(get_json_object(value, '{path}'))"
    rows = route(parsed, kind)
    every = ", ".join(f"after.`{name}`" for name in parsed.schema["after"].dataType.names)
    keep = f"(coalesce({every}) IS NOT NULL OR size({keys}) > 0)"
    if kind in S.INSERT_ONLY_KINDS:
        keep += f" AND lower(op) = '{S.INSERT.lower()}'"
    source_day = E.event_day_sql("event_ts", zone)
    today = source_day if business_date is None else f"CAST({business_date} AS INT)"
    carried = [*ORIGIN, "op", "row_id", "event_ts"]
    if "attempts" in parsed.columns:
        carried.append("attempts")
    texts = rows.where(keep).selectExpr(
        *carried,
        f"{source_day} AS source_day",
        f"{today} AS business_date",
        *[f"{_text(f, keys)} AS {f.name}" for f in fields],
    )
    # a step of its own, so that a number is cast once for its value and its reason
    typed = texts.selectExpr("*", *[f"try_cast({f.name} AS {f.type}) AS {_typed(f)}" for f in fields if f.type != "string"])
    # a generator, so that neither filters on the result nor its columns repeat the typing
    row = {"source_day": "source_day", "business_date": "business_date"}
    row |= {f.name: _typed(f) for f in fields} | {"reject_reason": _reject_reason(kind)}
    pairs = ", ".join(f"'{name}', {value}" for name, value in row.items())
    return typed.selectExpr(*carried, f"inline(array(named_struct({pairs})))")


def _differs(name: str, text: str) -> str:
    """Inequality that ignores case; a null passes as different."""
    return f"coalesce(lower({name}) <> '{text.lower()}', true)"


def _same(name: str, text: str) -> str:
    return f"lower({name}) = '{text.lower()}'"


# Filter of each kind; a routing key must be neither null nor empty.
ACCEPT = {
    "order": ["length(order_id) > 0", _differs("order_id", "0"), f"op = '{S.INSERT}'"],
    "fill": [
        "length(order_id) > 0",
        _differs("order_id", "0"),
        _differs("customer_id", ""),
        _differs("fill_id", ""),
        _same("cancel_flag", "O"),
    ],
    "customer": [_differs("customer_id", "")],
    "cash": [
        f"subject IN {(*E.CASH_IN_SUBJECTS, *E.CASH_OUT_SUBJECTS)}",
        _differs("customer_id", ""),
        _differs("ledger_id", ""),
    ],
    "otc": [_differs("order_id", "0"), "reg_date = CAST(business_date AS STRING)"],
    "stock_account": [
        "length(holder_acct) > 0",
        _differs("customer_id", ""),
        "open_date = business_date",
        "holder_status = '0'",
    ],
    "bank_account": [
        "length(bank_acct) > 0",
        _differs("customer_id", ""),
        "open_date = business_date",
    ],
    "dept_request": [
        _differs("request_id", S.ABSENT),
        _differs("row_id", S.ABSENT),
        "source_day = business_date",
    ],
    "fund_account": [
        _differs("customer_id", S.ABSENT),
        "open_date = business_date",
        _same("acct_status", "8"),
    ],
}


def accepted(typed: DataFrame, kind: str, rules: Rules | None = None) -> DataFrame:
    """Records that count, with the derived columns of their kind."""
    rows = typed.where(" AND ".join(["reject_reason IS NULL", *ACCEPT[kind]]))
    rows = rows.withColumnsRenamed({"partition": "src_partition", "offset": "src_offset"})
    rows = rows.drop("topic", "value", "reject_reason", "source_day")
    if kind == "order":
        return rows.withColumn("channel", classify(rules or {}))
    if kind == "customer":
        return rows.withColumn("cust_type", E.customer_type("cust_type_code"))
    if kind == "cash":
        direction = E.cash_direction("subject")
        return rows.withColumn("direction", direction).withColumn(
            "amount", E.cash_amount(F.col("direction"), "amt_in", "amt_out")
        )
    return rows


def records(
    parsed: DataFrame,
    kind: str,
    business_date: int | None = None,
    rules: Rules | None = None,
    zone: str = E.DEFAULT_ZONE,
) -> DataFrame:
    """Typed, filtered records of one kind."""
    return accepted(typed_records(parsed, kind, business_date, zone), kind, rules)


def rejected(rows: DataFrame) -> DataFrame:
    """Unusable rows of a parsed or typed frame, with the reason."""
    return rows.where("reject_reason IS NOT NULL").select(*ORIGIN, "reject_reason")


def of_use(typed: DataFrame, kind: str) -> DataFrame:
    """Of typed records those that count and those that are unusable."""
    return typed.where(f"reject_reason IS NOT NULL OR ({' AND '.join(ACCEPT[kind])})")


def without_text(typed: DataFrame) -> DataFrame:
    """Typed records without the text of the usable ones, which nothing reads any more."""
    return typed.withColumn("value", F.when(F.col("reject_reason").isNotNull(), F.col("value")))


def quarantine(
    parsed: DataFrame,
    kinds: tuple[str, ...] = tuple(S.FIELDS),
    business_date: int | None = None,
    zone: str = E.DEFAULT_ZONE,
) -> DataFrame:
    """Every message that cannot be used, with the reason; nothing else is lost."""
    out = rejected(parsed)
    for kind in kinds:
        out = out.unionByName(rejected(typed_records(parsed, kind, business_date, zone)))
    return out


def late_records(
    unwrapped: DataFrame,
    kind: str,
    business_date: int,
) -> DataFrame:
    """Typed records of re-queued messages, filtered as on first arrival.

    A wrapper carries no source time: it counts for ``business_date``.
    """
    return late_accepted(typed_records(unwrapped, kind, business_date, path="$.BASERECORD"), kind)


def late_accepted(typed: DataFrame, kind: str) -> DataFrame:
    """Of typed re-queued records those that count."""
    if kind == "otc":
        # the wrapper's own day gate always passes, so only the id is tested
        rows = typed.where(F.col("reject_reason").isNull() & ~E.same_text("order_id", "0"))
        rows = rows.withColumnsRenamed({"partition": "src_partition", "offset": "src_offset"})
        return rows.drop("topic", "value", "reject_reason", "source_day")
    if kind == "dept_request":
        typed = typed.withColumn("source_day", F.col("business_date"))
    return accepted(typed, kind)


def split_by_op(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(INSERTs, UPDATEs); other operations are ignored."""
    return rows.where(F.col("op") == S.INSERT), rows.where(F.col("op") == S.UPDATE)


def order_transitions(parsed: DataFrame, target: str = "2") -> DataFrame:
    """Order UPDATEs whose report result changes to ``target``."""
    after = F.trim(F.coalesce(F.col("after")["SBJG"], F.lit("")))
    before = F.trim(F.coalesce(F.col("before")["SBJG"], F.lit("")))
    return (
        route(parsed, "order")
        .where(E.same_text("op", S.UPDATE) & (before != target) & (after == target))
        .select(
            F.lit(S.UPDATE).alias("op"),
            F.coalesce(F.col("before")["WTH"], F.lit("0")).alias("order_id"),
            after.alias("report_result"),
            "event_ts",
            F.col("partition").alias("src_partition"),
            F.col("offset").alias("src_offset"),
        )
        .where("order_id <> '0'")
    )
