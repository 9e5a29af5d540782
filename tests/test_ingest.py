from decimal import Decimal

import pytest
from messages import DAY, RULES, TOPIC, fill, message, order, otc, raw, request

from tradepulse import schemas as S
from tradepulse.operators import project as P
from tradepulse.operators.ingest import parse_envelopes, unwrap_late


def records(spark, rows, kind, **kwargs):
    return P.records(parse_envelopes(raw(spark, rows)), kind, DAY, RULES, **kwargs).collect()


def reasons(spark, rows):
    bad = P.quarantine(parse_envelopes(raw(spark, rows)), business_date=DAY).collect()
    return {r["offset"]: r["reject_reason"] for r in bad}


def test_order_fields(spark):
    row = records(spark, [order(7)], "order")[0]
    assert (row["order_id"], row["qty"], row["price"]) == ("7", 100, Decimal("5.2500"))
    assert (row["channel"], row["business_date"], row["branch"]) == ("app", DAY, "B01")


@pytest.mark.parametrize(
    "changed,channel",
    [
        ({"WTGY": "OP2", "WTFS": "64"}, "desk"), ({"WTGY": "OP1", "WTFS": "64"}, "qt"),
        ({"WTGY": "none"}, "qt"), ({"WTGY": "DROP", "WTFS": "DROP"}, "qt"),
    ],
)
def test_channel(spark, changed, channel):
    assert records(spark, [order(7, **changed)], "order")[0]["channel"] == channel


def test_order_operations_and_keys(spark):
    rows = [
        order(1, op="UPDATE"), order(2, op="DELETE"), order(3, op="insert"), order(0), order(""),
        order(4, WTH="DROP"), order(5), order(6, WTH=None),
    ]
    assert [r["order_id"] for r in records(spark, rows, "order")] == ["5"]


def test_fill_filter(spark):
    rows = [
        fill(1), fill(2, op="insert"), fill(3, CXBZ="o"), fill(4, CXBZ="W"), fill(5, CXBZ=None),
        fill(6, fill_id=""), fill(7, KHH=""), fill(0), fill(""),
    ]
    assert sorted(r["order_id"] for r in records(spark, rows, "fill")) == ["1", "2", "3"]


def test_missing_takes_default_and_null_stays(spark):
    def customer(**after):
        return message("customer", {"KHH": "000142", **after})

    rows = records(spark, [customer(), customer(XHRQ=None), customer(XHRQ=str(DAY), KHZT=None)], "customer")
    assert [r["close_date"] for r in rows] == ["0", "nvl", str(DAY)]
    assert [r["cust_status"] for r in rows] == ["0", "0", None]
    assert [r["cust_type"] for r in rows] == [""] * 3

    def dept(**after):
        return message("dept_request", {"ID": "Q1", "YYB": "B", **after})

    rows = records(spark, [dept(), dept(KHH=None), dept(KHH="c")], "dept_request")
    assert [r["customer_id"] for r in rows] == ["0", "nvl", "c"]


def test_quarantine_names_every_reason_and_loses_nothing_else(spark):
    bad = [
        ("SECURITIES_TDRWT", 0, 1, '{"optype":"INSERT","after":{"KHH"'),
        ("SECURITIES_TDRWT", 0, 2, "[1]"),
        ("OTHER", 0, 3, "{}"),
        message("customer", {"KHH": "1"}, offset=4, jstime="DROP"),
        message("otc", {"WTH": "1"}, offset=5, jstime="123"),
        order(1, 6, WTSL="ten"), order(1, 7, ZQLB=None), order(1, 8, KHH="0001ABC"), order("X", 9),
        fill(1, offset=10, CJJE="x"), otc("nvl", "INSERT", 11),
        message("bank_account", {"KHH": "1", "ZJZH": "Z"}, offset=12),
        fill(1, offset=13, GDH=None),
    ]
    good = [order(1, 20), order(2, 21, KHH="0001"), fill(1, offset=22), ("SECURITIES_TDRWT", 0, 23, ""), ("SECURITIES_TDRWT", 0, 24, None)]
    assert reasons(spark, bad + good) == {
        1: "malformed_json", 2: "malformed_json", 3: "unknown_topic", 4: "bad_source_time",
        5: "bad_source_time", 6: "bad_number", 7: "null_field", 8: "bad_customer_id",
        9: "bad_order_id", 10: "bad_number", 11: "bad_order_id", 12: "bad_number", 13: "null_field",
    }
    assert len(records(spark, bad + good, "order")) == 2
    assert len(records(spark, bad + good, "fill")) == 1


def test_topic_case_and_empty_after(spark):
    lower = ("securities_tdrwt", *order(5)[1:])
    no_after = message("order", {})
    null_after = message("order", None)
    other_fields = message("order", {"FHGY": "1"})
    assert [r["order_id"] for r in records(spark, [lower, no_after, null_after, other_fields], "order")] == ["5"]
    assert reasons(spark, [no_after, null_after]) == {}


def test_day_gates(spark):
    def stock(**after):
        return message("stock_account", {"KHH": "c", "GDH": "E1", "KHRQ": str(DAY), "GDZT": "0", **after})

    rows = [stock(), stock(KHRQ="20240114"), stock(GDZT="1"), stock(GDZT=None), stock(GDH=""), stock(KHH="")]
    assert len(records(spark, rows, "stock_account")) == 1
    fund = [
        message("fund_account", {"KHH": "c", "KHRQ": str(DAY), "ZHZT": "8"}, op="DELETE"),
        message("fund_account", {"KHH": None, "KHRQ": str(DAY), "ZHZT": "8"}),
        message("fund_account", {"KHH": "c", "KHRQ": str(DAY), "ZHZT": "1"}),
    ]
    assert len(records(spark, fund, "fund_account")) == 1
    yesterday = request("Q1", "INSERT", seconds=-86400)
    assert len(records(spark, [request("Q1", "INSERT"), yesterday], "dept_request")) == 1
    assert len(records(spark, [request("Q1", "INSERT"), request("nvl", "INSERT")], "dept_request")) == 1
    assert len(records(spark, [otc(1, "INSERT"), otc(1, "INSERT", DJRQ="20240114"), otc(0, "INSERT")], "otc")) == 1


def test_cash_direction_and_amount(spark):
    def cash(subject, **after):
        return message("cash", {"KHH": "c", "LSH": "1", "YWKM": subject, "BZ": "RMB", "SRJE": "3", "FCJE": "4", **after})

    rows = records(spark, [cash("10113"), cash("10213"), cash("1"), cash("10113", LSH="")], "cash")
    assert [(r["direction"], r["amount"]) for r in rows] == [("zjzr", 3), ("zjzc", 4)]


def test_order_transitions(spark):
    def update(before, after, **kw):
        return message("order", {"SBJG": after}, op=kw.get("op", "UPDATE"), before={"WTH": "9", "SBJG": before})

    rows = [update("0", "2 "), update("2", "2"), update("0", "1"), update("0", "2", op="INSERT")]
    parsed = parse_envelopes(raw(spark, rows), before=True)
    assert [r["order_id"] for r in P.order_transitions(parsed).collect()] == ["9"]


def test_unwrap_late(spark):
    text = '{"originTopic":"SECURITIES_TSSCJ","baseRecord":{"khh":"000142","cjbh":"a","yyb":"b1","cjje":10.5,"s1":1,"cxbz":"O","wth":"3","gdh":"E1","bz":"usd","version":4}}'
    rows = P.late_records(unwrap_late(raw(spark, [("LATE", 0, 1, text)]), "late"), "fill", DAY).collect()
    assert [(r["order_id"], r["fill_id"], r["branch"], r["attempts"], r["fill_amt"]) for r in rows] == [("3", "A", "B1", 4, Decimal("10.5"))]


def test_without_fields_the_envelopes_are_the_same(spark):
    good = [order(1), fill(2), request("Q", "UPDATE"), ("NOWHERE", 0, 3, "{}"), ("NOWHERE", 0, 4, "")]
    odd = [(TOPIC["order"], 0, n, text) for n, text in enumerate((
        "", " ", "x", "[1]", '{"optype":"INSERT","after":{"WTH":"1"', '{"optype":"INSERT","after":"text"}',
        '{"optype":"INSERT","after":{"WTH":{"a":1}}}', '{"optype":"INSERT","after":{}}', '{"optype":"insert","jstime":"1705284000000000"}',
        '{"optype":"INSERT","after":null}', '{"optype":"INSERT","after":{"WTH":"\\q"}}', ' {"optype":null} trailing',
    ))]
    rows = raw(spark, good + odd + [(TOPIC["dept_request"], 0, 9, '{"optype":"INSERT","after":{"ID":"1"}}')])
    full, bare = parse_envelopes(rows), parse_envelopes(rows, fields=False)
    assert "after" not in bare.columns
    assert sorted(map(str, bare.collect())) == sorted(map(str, full.drop("after").collect()))


def test_wrapped_records_of_one_kind_read_its_fields_alone(spark):
    texts = ['{"originTopic":"securities_tssscj"}'] + [
        '{"originTopic":"%s","baseRecord":{"khh":"c%d","wth":"%d","cjbh":"1","cxbz":"o","bz":"x","gdh":"g","cjje":"1","clzt":"2","id":"q","sqrq":"1"%s}}' % (origin, n, n, more)
        for n, (origin, more) in enumerate((o, m) for o in ("SECURITIES_TSSCJ", "SECURITIES_TYWQQ", "SECURITIES_TYWSQLSKH") for m in ("", ',"version":2', ',"version":"x"', ',"yyb":null'))
    ]
    rows = raw(spark, [("LATE", 0, n, text) for n, text in enumerate(texts)])
    whole = unwrap_late(rows, "late")
    for kind in ("fill", "dept_request", "otc"):
        own = unwrap_late(rows, "late", kinds=[kind])
        assert len(own.schema["after"].dataType) == len(S.FIELDS[kind]) + 1
        got, want = (sorted(map(str, P.typed_records(u, kind, DAY, path="$.BASERECORD").collect())) for u in (own, whole))
        assert got == want and len(got) == 2
    bare = unwrap_late(rows, "late", kinds=())
    got, want = (sorted((r["offset"], str(r["reject_reason"]), r["reject_reason"] == "malformed_json" or r["kind"]) for r in u.collect()) for u in (bare, whole))
    assert got == want and len(got) == 13
