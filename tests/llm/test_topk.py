import logging
import math
import random

import pytest
from pyspark.sql import functions as F

from tradepulse.llm import catalogue, topk


def brute(vectors, queries, k):
    out = set()
    for q, a in queries:
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q  # noqa: B905
        )[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)}
    return out


def numbers(rows):
    kept = []
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    return kept


def test_matches_brute_force_on_the_given_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    kept = numbers(rows)
    got = {tuple(r) for r in catalogue.QUERIES["op1_top_k"](spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute(kept, [x for x in kept if x[0] % 50 == 0], 5)


def test_odd_vectors_ties_and_copies(spark):
    rows = [(i, [float((i * 7) % 5), 1.0, -0.5], "extra") for i in range(40)]
    rows += [(100 + i, [3.0, 2.0, 1.0], None) for i in range(30)]  # copies of one vector
    rows += [(200, None, None), (201, [1.0, None, 2.0], None), (202, [float("nan"), 0.0, 0.0], None), (203, [float("inf"), 0.0, 0.0], None)]
    rows += [(204, [2.0], None), (205, [], None), (None, [9.0, 9.0, 9.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string")
    vectors = df.select(F.col("vec_id").alias("id"), F.expr(topk.whole_numbers()).alias("v"))
    got = {tuple(r) for r in topk.top_k(vectors, vectors.filter("id % 10 = 0"), 5).collect()}
    kept = [(i, v + [0] * (3 - len(v))) for i, v in numbers(rows)]
    assert got == brute(kept, [x for x in kept if x[0] % 10 == 0], 5)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_candidates(spark, n):
    df = spark.createDataFrame([(i * 50, [i, 1]) for i in range(n)], "id long, v array<long>")
    assert topk.top_k(df, df, 5).count() == n * max(n - 1, 0)


def clustered(n, centres, seed=5):
    chance = random.Random(seed)
    spots = [[chance.randint(-4000, 4000) for _ in range(8)] for _ in range(centres)]
    return [(i, [x + chance.randint(-60, 60) for x in spots[i % centres]]) for i in range(n)]


def test_far_annuli_are_not_fetched(spark, caplog, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 32)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rows = clustered(3000, 24)
    df = spark.createDataFrame(rows, "id long, v array<long>")
    asked = [r for r in rows if r[0] % 50 == 0]
    with caplog.at_level(logging.INFO, logger=topk.__name__):
        got = {tuple(r) for r in topk.top_k(df, df.filter("id % 50 = 0"), 5).collect()}
    assert got == brute(rows, asked, 5)
    (scored, everything), = [r.args for r in caplog.records if r.name == topk.__name__]
    assert scored < everything / 2


def test_pivots_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 4)
    df = spark.createDataFrame(clustered(2000, 300), "id long, v array<long>")
    assert len(topk.choose_pivots(df).points) == 2000 // (4 * topk.ANNULI)


def test_copies_of_annuli_for_many_visitors(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "MEETING", 3)
    rows = clustered(300, 5)
    df = spark.createDataFrame(rows, "id long, v array<long>")
    assert {tuple(r) for r in topk.top_k(df, df, 3).collect()} == brute(rows, rows, 3)


def test_query_rows_that_share_an_id_have_one_result(spark):
    rows = [(1, [5, 0]), (1, [0, 7]), (2, [3, 0]), (3, [0, 2]), (4, [1, 1]), (4, [2, 2])]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = {tuple(r) for r in topk.top_k(df, df.filter("id = 1"), 4).collect()}
    assert got == {(1, 1, 2, 15), (1, 2, 3, 14), (1, 3, 4, 14), (1, 4, 4, 10)}


def test_numbers_of_every_size(spark):
    rows = [(i, [(-1) ** i * (1 << (i * 2)), 3 - i, -32768]) for i in range(14)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    assert {tuple(r) for r in topk.top_k(df, df, 5).collect()} == brute(rows, rows, 5)
