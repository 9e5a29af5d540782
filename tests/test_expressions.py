import json
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tradepulse.functions import expressions as E
from tradepulse.functions.rules import classify, classify_by_table, rule_list
from tradepulse.operators import customers as C
from tradepulse.operators import metrics as M
from tradepulse.sources.rules import read_rule_sets, read_rules, rule_table

RULES = {
    "first": [{"a": ["1", "2"], "b": ["x"]}],
    "second": [{"a": ["9"]}, {"a": ["1"], "b": ["x", "y"]}],
    "never": [{}],
}


def values(df, column="out"):
    return [r[column] for r in df.collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "code,group",
    [
        ("A0", "stock"), ("A9", "bond"), ("a9", "bond"), ("A99", "stock"), ("G0", "stock"),
        ("g0", "stock"), ("G1", None), ("F1", "stock"), ("E1", "fund"), ("H1", "bond"),
        ("Z", "bond"), ("T8", "fund"), ("", None), ("x", None), ("a0", None),
    ],
)
def test_security_group(spark, code, group):
    assert one(spark, E.security_group(F.lit(code))) == group


@pytest.mark.parametrize(
    "customer,ordinal,bad",
    [
        ("000100000042", 42, False), ("0001", None, False), ("", None, False),
        ("0001X2", None, True), ("00017", 7, False), ("0002000000042", 42, False),
    ],
)
def test_customer_ordinal(spark, customer, ordinal, bad):
    assert one(spark, E.customer_ordinal(F.lit(customer))) == ordinal
    assert one(spark, E.bad_customer_id(F.lit(customer))) is bad


@pytest.mark.parametrize(
    "micros,day",
    [
        ("1705334399000000", 20240115),  # 23:59:59 in Shanghai
        ("1705334400000000", 20240116),  # midnight there, still the 15th in UTC
        ("1705334400", None),
        ("abcdefghijklmnop", None),
        (None, None),
    ],
)
def test_event_day(spark, micros, day):
    ts = E.source_timestamp(F.lit(micros).cast("string"))
    assert one(spark, E.event_day(ts)) == day
    text = "NULL" if micros is None else f"'{micros}'"
    sql_ts = E.source_timestamp_sql(f"CAST({text} AS STRING)")
    assert one(spark, F.expr(E.event_day_sql(sql_ts))) == day


def test_event_day_does_not_follow_session_zone(spark):
    ts = E.source_timestamp(F.lit("1705334400000000"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, E.event_day(ts)) == 20240116
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_margin_cash_and_types(spark):
    assert one(spark, E.is_margin_fill(F.lit("0612"))) is True
    assert one(spark, E.is_margin_fill(F.lit("e1"))) is False
    assert one(spark, E.is_margin_order(F.lit("O"), F.lit("5"))) is True
    assert one(spark, E.is_margin_order(F.lit("o"), F.lit("5"))) is False
    assert one(spark, E.cash_direction(F.lit("10113"))) == "zjzr"
    assert one(spark, E.cash_direction(F.lit("10213"))) == "zjzc"
    assert one(spark, E.cash_direction(F.lit("1"))) is None
    assert [one(spark, E.customer_type(F.lit(c))) for c in (0, 1, 2)] == ["gr", "jg", ""]


def test_sentinels(spark):
    assert one(spark, E.present(F.lit("NVL"))) is None
    assert one(spark, E.present(F.lit("x"))) == "x"
    assert one(spark, E.non_zero(F.lit("0.00").cast("decimal(18,4)"))) is None


def test_conversion_keeps_all_decimals_and_defaults_to_one(spark):
    rows = spark.createDataFrame(
        [("k", "usd ", Decimal("12345678901234.5678")), ("k", "xxx", Decimal("0.0001"))],
        "k STRING, currency STRING, amount DECIMAL(18,4)",
    )
    rates = spark.createDataFrame(
        [("USD", Decimal("1.00000001"))], "currency STRING, rate DECIMAL(15,8)"
    )
    out = M.totals_by_currency(rows, rates, ["k"], {"n": F.count(F.lit(1))}, {"amt": F.col("amount")})
    assert out.first()["amt"] == Decimal("12345678901234.5678") * Decimal("1.00000001") + Decimal("0.0001")


def test_classify_and_table_agree(spark, tmp_path):
    import json

    path = tmp_path / "channel.json"
    path.write_text(json.dumps(RULES))
    df = spark.createDataFrame(
        [("1", "x"), ("1", "y"), ("9", "q"), ("2", "y"), ("", None), (None, None)], "a STRING, b STRING"
    )
    expected = ["first", "second", "second", "qt", "qt", "qt"]
    assert read_rules(spark, str(path)) == RULES
    assert read_rule_sets(spark, str(tmp_path), ["channel"]) == {"channel": RULES}
    assert rule_list(RULES, "second") == RULES["second"]
    assert values(df.select(classify(RULES).alias("out"))) == expected
    by_table = classify_by_table(df, rule_table(spark, str(path), "channel"), ["a", "b"], out="out")
    assert sorted(map(str, ((r["a"], r["b"], r["out"]) for r in by_table.collect()))) == sorted(
        map(str, ((a, b, o) for (a, b), o in zip([tuple(r) for r in df.collect()], expected)))
    )
    assert values(df.select(classify({}).alias("out"))) == ["qt"] * 6


def test_long_customer_ids_stay_apart(spark):
    ids = ["0001" + f"{n:021d}" for n in (17, 18)] + ["0001", "00019" * 8, "0001x", None]
    df = spark.createDataFrame([(i,) for i in ids], "c STRING")
    rows = df.select(
        E.customer_ordinal("c").alias("n"), E.bad_customer_id("c").alias("bad"), F.expr(E.bad_customer_id_sql("c")).alias("bad_sql")
    ).collect()
    assert [r["n"] for r in rows] == [17, 18, None, None, None, None]
    assert [r["bad"] for r in rows] == [r["bad_sql"] for r in rows] == [False, False, False, True, True, None]


def test_long_rule_sets_keep_file_order(spark, tmp_path):
    rules = {"a": [{"f": [f"v{i}"]} for i in range(100_002)], "b": [{"f": ["v100001"]}]}
    rules |= {f"c{i}": [{"f": ["w"]}] for i in range(21_600)}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    table = rule_table(spark, str(tmp_path / "rules.json"), "r")
    df = spark.createDataFrame([("v100001",), ("w",), ("none",)], "f STRING")
    got = {r["f"]: r["channel"] for r in classify_by_table(df, table, ["f"]).collect()}
    assert got == {"v100001": "a", "w": "c0", "none": "qt"}


def test_several_rule_files_are_refused(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text("{}")
    with pytest.raises(ValueError, match="several"):
        read_rules(spark, str(tmp_path))


def test_sums_of_the_largest_amounts_convert_exactly(spark):
    """Far beyond one decimal product: upper and lower digits are converted apart."""
    cases = ["1979999999999999999.9999", "-1979999999999999999.9999", "0.0001", "999999999.9999", "1000000000", "123456789012345678901.2345", None]
    rate = Decimal("7.12345678")
    df = spark.createDataFrame([(None if c is None else Decimal(c),) for c in cases], "total decimal(38,4)")
    got = [r[0] for r in df.select(E.converted_sum("total", F.lit(rate).cast("decimal(15,8)"))).collect()]
    with localcontext() as c:
        c.prec = 60
        assert got == [None if t is None else Decimal(t) * rate for t in cases]


def test_customer_words_equal_distinct_ids(spark):
    ids = ["0001" + str(n) for n in (0, 1, 63, 64, 65, 127, 10**12, 10**12 + 1, 2**62)] * 3 + ["0001", "1", "0001x", None]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(ids)], "g int, customer_id string").repartition(3)
    words = C.customer_words(df, ["g"])
    merged = C.merge_words(words.unionByName(words), ["g"])
    want = {g: len({v for i, v in enumerate(ids) if i % 2 == g and v and v[4:].isdigit()}) for g in (0, 1)}
    assert {r.g: r.cust_nums for r in C.word_counts(merged, ["g"]).collect()} == want
    dense = spark.range(10_000).select(F.lit(0).alias("g"), F.concat(F.lit("0001"), F.col("id").cast("string")).alias("customer_id"))
    assert C.customer_words(dense, ["g"]).count() == 157
