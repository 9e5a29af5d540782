"""Record kinds, their source fields and defaults, and shared types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = "decimal(18,4)"
RATE = "decimal(15,8)"
# one amount, narrow enough that times RATE keeps all 12 decimals
AMOUNT = "decimal(22,4)"
# Quantity times price of a usable order lies below this, as every single amount
# does; a sum has room for a hundred thousand million times as much.
LARGEST_VALUE = 10**14
# Sums are converted in two parts, cut at this power of ten.
CUT = 10**9
CONVERTED = "decimal(38,12)"

INSERT = "INSERT"
UPDATE = "UPDATE"
ABSENT = "nvl"
UNMATCHED_CHANNEL = "undefine"
OTHER_CHANNEL = "qt"
INDIVIDUAL = "gr"
INSTITUTION = "jg"
CASH_IN = "zjzr"
CASH_OUT = "zjzc"

# Raw message as a stream delivers it.
RAW_SCHEMA = StructType(
    [
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("value", StringType()),
    ]
)


@dataclass(frozen=True)
class Field:
    """One after-image field: where it comes from and what stands in for it.

    ``missing`` replaces an absent key. A JSON null stays null unless
    ``null_as`` is given. ``required`` rejects an INSERT whose value is null.
    """

    source: str
    name: str
    missing: str
    type: str = "string"
    null_as: str | None = None
    required: bool = False


# Topic names and, per record kind, source field names with
# their defaults.
TOPICS = {
    "SECURITIES_TDRWT": "order",
    "SECURITIES_TSSCJ": "fill",
    "CIF_TKHXX": "customer",
    "ACCOUNT_TDRZJMX": "cash",
    "FPSS_TFP_YWSQLS": "otc",
    "CIF_TGDZH": "stock_account",
    "CIF_TZJZH": "bank_account",
    "CIF_TYWQQ": "dept_request",
    "OFS_TOF_JJZH": "fund_account",
}

# Topic of wrapped late messages, and the origin names they carry.
LATE_TOPIC = "TRADE_MONITOR_SLOW"
LATE_ORIGINS = {
    "SECURITIES_TSSCJ": "fill",
    "SECURITIES_TYWQQ": "dept_request",
    "SECURITIES_TYWSQLSKH": "otc",
}

FIELDS: dict[str, tuple[Field, ...]] = {
    "order": (
        Field("KHH", "customer_id", "", required=True),
        Field("WTH", "order_id", "0"),
        Field("YYB", "branch", "", required=True),
        Field("WTFS", "entry_mode", "", required=True),
        Field("WTGY", "entry_operator", "", required=True),
        Field("BZ", "currency", "", required=True),
        Field("WTSL", "qty", "0", "int"),
        Field("WTJG", "price", "0", MONEY),
        Field("SBJG", "report_result", "", required=True),
        Field("CXBZ", "cancel_flag", "", required=True),
        Field("JSLX", "settle_type", "", required=True),
        Field("ZQLB", "sec_class", "", required=True),
    ),
    "fill": (
        Field("KHH", "customer_id", "", required=True),
        Field("CJBH", "fill_id", ""),
        Field("YYB", "branch", ""),
        Field("BZ", "currency", "", required=True),
        Field("CJJE", "fill_amt", "0", MONEY),
        Field("S1", "commission", "0", MONEY),
        Field("CXBZ", "cancel_flag", ""),
        Field("WTH", "order_id", "0"),
        Field("GDH", "holder_acct", "", required=True),
    ),
    "customer": (
        Field("KHH", "customer_id", ""),
        Field("KHRQ", "open_date", "0", "int"),
        Field("KHLB", "cust_type_code", "-1", "int"),
        Field("KHZT", "cust_status", "0"),
        Field("XHRQ", "close_date", "0", null_as=ABSENT),
    ),
    "cash": (
        Field("KHH", "customer_id", ""),
        Field("LSH", "ledger_id", ""),
        Field("YWKM", "subject", ""),
        Field("BZ", "currency", "", required=True),
        Field("SRJE", "amt_in", "0", MONEY),
        Field("FCJE", "amt_out", "0", MONEY),
    ),
    "otc": (
        Field("WTH", "order_id", ABSENT),
        Field("KHH", "customer_id", ABSENT, null_as=ABSENT),
        Field("YWDM", "biz_code", ABSENT, required=True),
        Field("CLZT", "proc_status", ABSENT, required=True),
        Field("CLJG", "proc_result", ABSENT, null_as=ABSENT),
        Field("CPFL", "prod_class", ABSENT, null_as=ABSENT),
        Field("YWJE", "biz_amt", "0", MONEY),
        Field("DJRQ", "reg_date", ABSENT),
        Field("CPID", "prod_id", ABSENT, null_as=ABSENT),
    ),
    "stock_account": (
        Field("KHH", "customer_id", ""),
        Field("GDH", "holder_acct", ""),
        Field("KHRQ", "open_date", "0", "int"),
        Field("GDZT", "holder_status", "-1"),
        Field("ZHLB", "acct_class", ""),
    ),
    "bank_account": (
        Field("KHH", "customer_id", ""),
        Field("ZJZH", "bank_acct", ""),
        Field("KHRQ", "open_date", "", "int"),
        Field("ZHZT", "acct_status", ""),
    ),
    "dept_request": (
        Field("ID", "request_id", ABSENT, required=True),
        Field("KHH", "customer_id", "0", null_as=ABSENT),
        Field("SQRQ", "request_date", "0", "int"),
        Field("YYB", "branch", "", required=True),
        Field("CLZT", "proc_status", "0", required=True),
    ),
    "fund_account": (
        Field("KHH", "customer_id", "0", null_as=ABSENT),
        Field("JJZH", "fund_acct", ABSENT),
        Field("KHRQ", "open_date", "0", "int"),
        Field("ZHZT", "acct_status", "0"),
    ),
}

# Kinds whose parsers need the source time; a message without it is rejected.
TIMED_KINDS = ("customer", "otc", "dept_request", "fund_account")

# Kinds of which only INSERT messages count.
INSERT_ONLY_KINDS = ("order", "fill", "cash", "stock_account", "bank_account")

BEFORE_FIELDS = ("WTH", "SBJG")


def after_fields(kinds: Sequence[str] | None = None) -> tuple[str, ...]:
    """Source fields of the given kinds, of all if left out."""
    chosen = FIELDS if kinds is None else kinds
    return tuple(dict.fromkeys(f.source for kind in chosen for f in FIELDS[kind]))


#: Stands for the fields of a record of which only the presence is read.
NO_FIELD = ("_",)


def envelope_ddl(before: bool = False, kinds: Sequence[str] | None = None, fields: bool = True) -> str:
    """Read schema of a message: only the fields that the kinds use, or none of them."""
    after = ",".join(f"`{name}`:STRING" for name in (after_fields(kinds) if fields else NO_FIELD))
    ddl = f"optype STRING, rowid STRING, jstime STRING, after STRUCT<{after}>"
    if before:
        fields = ",".join(f"`{name}`:STRING" for name in BEFORE_FIELDS)
        ddl += f", before STRUCT<{fields}>"
    return ddl + ", _corrupt_record STRING"


def late_ddl(kinds: Sequence[str] | None = None) -> str:
    """Read schema of an upper-cased late wrapper: only the fields that the kinds use."""
    record = ",".join(f"`{name}`:STRING" for name in (*after_fields(kinds), "VERSION"))
    return f"ORIGINTOPIC STRING, BASERECORD STRUCT<{record}>, _corrupt_record STRING"


def record_schema(kind: str) -> StructType:
    """Typed fields of one record kind."""
    types = {"string": StringType(), "int": IntegerType(), MONEY: DecimalType(18, 4)}
    return StructType([StructField(f.name, types[f.type]) for f in FIELDS[kind]])
