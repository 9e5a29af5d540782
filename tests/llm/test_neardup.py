import random
import re
from collections import Counter

import pytest
from rows import SCHEMA, documents, empty, frame

from tradepulse.llm import neardup
from tradepulse.llm.components import components


def word_sets(rows, width):
    out = {}
    for i, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        grams = {tuple(words[k : k + width]) for k in range(max(len(words) - width + 1, 1))} if words else set()
        out.setdefault(i, []).append(grams)
    return out


def brute(rows, width, least=80):
    sets = [(i, s) for i, own in word_sets(rows, width).items() for s in own]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    holders = {}
    for n, (_, s) in enumerate(sets):
        for gram in s:
            holders.setdefault(gram, []).append(n)
    for n, (i, s) in enumerate(sets):
        for m, shared in Counter(m for gram in s for m in holders[gram] if m < n).items():
            j, t = sets[m]
            if 100 * shared >= least * (len(s) + len(t) - shared):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: find(i) for i in top}


@pytest.mark.parametrize("width", [4, 5])
def test_matches_brute_force_on_the_given_table(spark, sf_dir, width):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = neardup.near_duplicates(docs, width).collect()
    assert {r.id: r.component_id for r in got} == brute(rows, width)
    assert {r.id: r.n_shingles for r in got} == {i: len(s[0]) for i, s in word_sets(rows, width).items()}
    assert all(r.kept == (r.id == r.component_id) for r in got)


def test_odd_rows(spark):
    rows = documents()
    got = neardup.near_duplicates(frame(spark, rows), 4).collect()
    assert len(got) == len(rows)
    named = {r.id: r.component_id for r in got if r.id is not None}
    assert named == brute([(r[0], r[1]) for r in rows if r[0] is not None], 4)
    assert [r.kept for r in got if r.id is None] == [True]


def test_a_group_of_near_copies_in_many_tiles(spark, monkeypatch):
    """Copies that stray from their leader are still linked to one another."""
    monkeypatch.setattr(neardup, "TILE", 8)
    chance = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for n in range(150):
        words = list(base)
        for _ in range(chance.randint(0, 9)):
            words[chance.randrange(120)] = f"x{chance.randrange(30)}" if n % 3 else "same"
        rows.append((n, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert {r.id: r.component_id for r in neardup.near_duplicates(df, 4).collect()} == brute(rows, 4)


def test_empty_table(spark):
    got = neardup.near_duplicates(empty(spark))
    assert got.columns == ["id", "n_shingles", "component_id", "kept"] and got.count() == 0
    assert SCHEMA


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(10, 90)] + [(3, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in [7, *range(10, 90)]}}
