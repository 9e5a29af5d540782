import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from rows import documents, empty, frame

from tradepulse.llm import catalogue, hilbert


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    index = hilbert.curve_index(list(cells.T), bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def check(rows, got, shards=24):
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = [[r.slot for r in got if r.shard == s] for s in range(shards)]
    assert sum(map(len, slots)) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(map(len, slots)) - min(map(len, slots)) <= 1
    curve = [r.curve for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)


def test_given_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = catalogue.QUERIES["op6_sharding"](spark, sf_dir).collect()
    check(rows, got)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


@pytest.mark.parametrize("run", [2000, 3])
def test_odd_rows_and_split_cells(spark, monkeypatch, run):
    monkeypatch.setattr(hilbert, "RUN", run)
    rows = documents()
    df = frame(spark, rows)
    got = hilbert.sharded(df).collect()
    check([(r[0], r[1]) for r in rows], got)
    assert sorted(map(str, got)) == sorted(map(str, hilbert.sharded(df.repartition(2)).collect()))


def test_few_rows_and_none(spark):
    check([(r[0], r[1]) for r in documents()[:5]], hilbert.sharded(frame(spark, documents()[:5])).collect())
    assert hilbert.sharded(empty(spark)).count() == 0


def test_cells_of_many_values_follow_their_order(spark):
    values = [None, "", *[f"v{i:03}" for i in range(150)]]
    df = spark.createDataFrame([(v,) for v in values * 2], "name string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = hilbert.rank_cells(df, "name", "cell").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {v: i * 32 // len(values) for i, v in enumerate(values)}
    assert sorted((r.name or "", r.cell) for r in got) == sorted((v or "", want[v]) for v in values * 2)
