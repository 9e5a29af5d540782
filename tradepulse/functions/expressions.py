"""Column builders for the derived fields; every one is a built-in expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradepulse import schemas as S

DEFAULT_ZONE = "Asia/Shanghai"

# Security class prefixes and exact codes of each group.
STOCK_PREFIXES = ("A", "F", "C", "R", "N")
STOCK_CODES = ("G0",)
FUND_PREFIXES = ("E", "J", "L", "T")
BOND_PREFIXES = ("H", "Z")
BOND_CODES = ("A9",)
# Holder-account prefixes of margin accounts.
MARGIN_PREFIXES = ("E", "06")
# Ledger subjects of cash moving in and out.
CASH_IN_SUBJECTS = ("10113",)
CASH_OUT_SUBJECTS = ("10213",)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _starts_with_any(value: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for prefix in prefixes:
        out = out | value.startswith(prefix)
    return out


def currency_key(value: Column | str) -> Column:
    """Currency code as the rate table keys it."""
    return F.upper(F.trim(_col(value)))


def rate_or_one(rate: Column | str = "rate") -> Column:
    """A currency without a rate converts at 1."""
    return F.coalesce(_col(rate), F.lit(1).cast(S.RATE))


def converted(amount: Column | str, rate: Column | str = "rate") -> Column:
    """One amount times its rate, without losing decimals."""
    return (_col(amount).cast(S.AMOUNT) * rate_or_one(rate)).cast(S.CONVERTED)


def converted_sum(total: Column | str, rate: Column | str = "rate") -> Column:
    """``sum(amount) * rate`` without losing decimals, of sums up to what the result type holds.

    The rate is constant within a currency, so converting the sum equals summing
    the converted amounts and costs one multiplication per group, not per row. A sum
    times a rate has more digits than a decimal keeps, hence the upper digits are
    converted apart from the lower ones; both products are exact.
    """
    total = _col(total).cast("decimal(38,4)")
    upper = F.call_function("div", total, F.lit(S.CUT)).cast("decimal(19,0)")
    lower = (total % F.lit(S.CUT)).cast("decimal(13,4)")
    rate = rate_or_one(rate).cast(S.RATE)
    whole = ((upper * rate).cast("decimal(29,8)") * F.lit(S.CUT).cast("decimal(10,0)")).cast("decimal(37,12)")
    return (whole + lower * rate).cast(S.CONVERTED)


def order_value(qty: Column | str, price: Column | str) -> Column:
    """Quantity times price, before conversion."""
    return (_col(qty).cast("decimal(10,0)") * _col(price).cast(S.MONEY)).cast("decimal(28,4)")


def is_margin_order(cancel_flag: Column | str, settle_type: Column | str) -> Column:
    return (_col(cancel_flag) == "O") & (_col(settle_type) == "5")


def security_group(sec_class: Column | str) -> Column:
    """``stock``, ``fund``, ``bond`` or null, by class prefix."""
    code = _col(sec_class)
    upper = F.upper(code)
    bond = _starts_with_any(code, BOND_PREFIXES) | upper.isin(*BOND_CODES)
    fund = _starts_with_any(code, FUND_PREFIXES)
    stock = _starts_with_any(code, STOCK_PREFIXES) | upper.isin(*STOCK_CODES)
    return F.when(bond, "bond").when(fund, "fund").when(stock, "stock")


def is_margin_fill(holder_acct: Column | str, prefixes: Sequence[str] = MARGIN_PREFIXES) -> Column:
    return _starts_with_any(_col(holder_acct), prefixes)


def customer_type(code: Column | str) -> Column:
    value = _col(code)
    return F.when(value == 0, S.INDIVIDUAL).when(value == 1, S.INSTITUTION).otherwise("")


def cash_direction(subject: Column | str) -> Column:
    """``zjzr`` in, ``zjzc`` out, null for every other subject."""
    value = _col(subject)
    return F.when(value.isin(*CASH_IN_SUBJECTS), S.CASH_IN).when(
        value.isin(*CASH_OUT_SUBJECTS), S.CASH_OUT
    )


def cash_amount(direction: Column, amt_in: Column | str, amt_out: Column | str) -> Column:
    return F.when(direction == S.CASH_IN, _col(amt_in)).when(direction == S.CASH_OUT, _col(amt_out))


def source_timestamp(micros_text: Column | str) -> Column:
    """Instant of a 16-digit epoch-microsecond text; null when unusable."""
    text = _col(micros_text)
    millis = F.substring(text, 1, 13).try_cast("bigint")
    return F.when(F.length(text) >= 13, F.timestamp_millis(millis))


def source_timestamp_sql(micros_text: str) -> str:
    """The same as SQL text, for wide projections."""
    millis = f"try_cast(substring({micros_text}, 1, 13) AS BIGINT)"
    return f"CASE WHEN length({micros_text}) >= 13 THEN timestamp_millis({millis}) END"


def event_day(ts: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """Calendar day (yyyyMMdd INT) of an instant in ``zone``."""
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), _col(ts).cast("timestamp_ntz"))
    return day_int(local)


def event_day_sql(ts: str, zone: str = DEFAULT_ZONE) -> str:
    """The same as SQL text, for wide projections."""
    local = f"convert_timezone(current_timezone(), '{zone}', CAST({ts} AS TIMESTAMP_NTZ))"
    return f"CAST(year({local}) * 10000 + month({local}) * 100 + dayofmonth({local}) AS INT)"


def day_int(ts: Column | str) -> Column:
    """yyyyMMdd INT of a zone-less timestamp or date."""
    value = _col(ts)
    return (F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)).cast("int")


def stat_time() -> Column:
    """Write time of a result row."""
    return F.current_timestamp()


def customer_ordinal(customer_id: Column | str, start: int = 5) -> Column:
    """Number behind a customer id's prefix; null when there is none.

    All that follows the prefix is the number, however long. An id no longer than
    the prefix yields null: its trades count, it does not count as a customer.
    """
    value = _col(customer_id)
    number = value.substr(F.lit(start), F.length(value)).try_cast("bigint")
    return F.when((F.length(value) >= start) & (number >= 0), number)


def bad_customer_id_sql(customer_id: str, start: int = 5) -> str:
    """:func:`bad_customer_id` as SQL text, for wide projections."""
    number = f"try_cast(substring({customer_id}, {start}) AS BIGINT)"
    return f"length({customer_id}) >= {start} AND coalesce({number}, -1) < 0"


def bad_customer_id(customer_id: Column | str, start: int = 5) -> Column:
    """Long enough to carry a number, but does not."""
    value = _col(customer_id)
    return (F.length(value) >= start) & customer_ordinal(value, start).isNull()


def present(value: Column | str, absent: str = S.ABSENT) -> Column:
    """Null for the sentinel that stands for an absent field."""
    text = _col(value)
    return F.when(F.lower(text) != absent.lower(), text)


def non_zero(value: Column | str) -> Column:
    amount = _col(value)
    return F.when(amount != 0, amount)


def same_text(left: Column | str, right: str) -> Column:
    """Equality that ignores case; null counts as unequal."""
    return F.coalesce(F.lower(_col(left)) == right.lower(), F.lit(False))


def as_json(*columns: str | Column) -> Column:
    """JSON text of a record; nulls are written, not dropped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
