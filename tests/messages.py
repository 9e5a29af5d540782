"""Small hand-made change messages."""

from __future__ import annotations

import json

from tradepulse import schemas as S

DAY = 20240115
# 2024-01-15 10:00:00 in Shanghai
BASE_MICROS = 1705284000000000
RULES = {"app": [{"entry_operator": ["OP1"], "entry_mode": ["32"]}], "desk": [{"entry_operator": ["OP2"], "entry_mode": ["64"]}]}
TOPIC = {kind: topic for topic, kind in S.TOPICS.items()}


def message(kind, after, op="INSERT", offset=0, seconds=0, rowid="R1", **changed):
    envelope = {
        "optype": op,
        "rowid": rowid,
        "jstime": str(BASE_MICROS + seconds * 1_000_000),
        "after": after,
        **changed,
    }
    envelope = {k: v for k, v in envelope.items() if v != "DROP"}
    return (TOPIC.get(kind, kind), 0, offset, json.dumps(envelope))


def order(order_id, offset=0, op="INSERT", seconds=0, **changed):
    after = {
        "KHH": "000100000042", "WTH": str(order_id), "YYB": "B01", "WTFS": "32", "WTGY": "OP1",
        "BZ": "RMB", "WTSL": "100", "WTJG": "5.25", "SBJG": "0", "CXBZ": "O", "JSLX": "5",
        "ZQLB": "A0", "FHGY": None, **changed,
    }
    after = {k: v for k, v in after.items() if v != "DROP"}
    return message("order", after, op, offset, seconds)


def fill(order_id, fill_id="1", offset=0, op="INSERT", seconds=0, **changed):
    after = {
        "KHH": "000100000042", "CJBH": fill_id, "YYB": "B02", "BZ": "usd", "CJJE": "10.5",
        "S1": "0.25", "CXBZ": "O", "WTH": str(order_id), "GDH": "E123", **changed,
    }
    after = {k: v for k, v in after.items() if v != "DROP"}
    return message("fill", after, op, offset, seconds)


def request(request_id, op, offset=0, day=DAY, branch="B01", status="8", seconds=0):
    after = {"ID": request_id, "KHH": "000100000042", "SQRQ": str(day), "YYB": branch, "CLZT": status}
    return message("dept_request", after, op, offset, seconds)


def otc(order_id, op, offset=0, seconds=0, **changed):
    after = {
        "WTH": str(order_id), "KHH": "000100000042", "YWDM": "1", "CLZT": "2", "CLJG": "1",
        "CPFL": "14", "YWJE": "100", "DJRQ": str(DAY), "CPID": "77", **changed,
    }
    after = {k: v for k, v in after.items() if v != "DROP"}
    return message("otc", after, op, offset, seconds)


def raw(spark, rows):
    return spark.createDataFrame(rows, S.RAW_SCHEMA)
