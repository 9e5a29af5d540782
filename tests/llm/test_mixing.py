import re
from collections import Counter, defaultdict

import pytest
from rows import documents, empty, frame

from tradepulse.llm import catalogue, mixing


def expected_targets(sizes):
    """By sharing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, full = dict.fromkeys(order, 0.0), set()
    left = float(sum(sizes.values()))
    while left > 1e-9:
        open_sources = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_sources)
        given, left = left, 0.0
        for s in open_sources:
            target[s] += given * weight[s] / total
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                full.add(s)
    return target


def check(rows, got):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = expected_targets(sizes)
    taken = Counter()
    for r, source in got:
        assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for source, words in target.items():
        assert abs(taken[source] - words) <= mixing.BLOCK


def test_targets_and_taken_words_of_the_given_table(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    first = catalogue.QUERIES["op5_mixing"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in first) == sorted(docs)
    check([(r.doc_id, r.text, r.source) for r in docs.values()], [(r, docs[r.doc_id].source) for r in first])
    again = catalogue.QUERIES["op5_mixing"](spark, sf_dir).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_odd_rows(spark):
    rows = documents()
    got = mixing.taken(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    check([(r[0], r[1], r[3]) for r in rows], [(r, source[r.doc_id]) for r in got])
    assert mixing.taken(empty(spark)).count() == 0


def test_one_tiny_source_stops_at_three_times_its_size(spark):
    rows = [(1, "a b", "x"), (2, " ".join(["w"] * 5000), "y"), (3, "", "z")]
    got = {r.doc_id: r for r in mixing.taken(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1].taken == 6 and got[3].taken == 0 and abs(got[2].taken - 4996) <= mixing.BLOCK


def test_permutation_is_one(spark):
    df = spark.range(1000).select(mixing.permuted(*(x.cast("long") for x in _columns())).alias("p"))
    assert sorted(r.p for r in df.collect()) == list(range(1000))
    assert [r.p for r in df.limit(20).collect()] != list(range(20))


def _columns():
    from pyspark.sql import functions as F

    return F.col("id"), F.lit(1000), F.lit(4)


def test_mix_fills_every_slot_once_and_texts_follow(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(i * 13 % 300)), f"s{i % 4}", 7) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken long")
    words = {r.doc_id: r.taken for r in mixing.taken(df).collect()}
    out = mixing.mixed(df).collect()
    assert mixing.mixed(df).columns == df.columns
    counted = Counter()
    for r in out:
        own = r.text.split(" ")
        assert set(own) <= set(rows[r.doc_id][1].split(" ")) and r.taken == 7
        counted[r.doc_id] += len(own)
    assert counted == Counter({i: n for i, n in words.items() if n})


def test_slots_of_each_shard_are_as_many_as_were_drawn(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(i * 37 % 900)), f"s{i % 4}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = df.select("doc_id", "source", mixing.word_count("text").alias("size"))
    sources = mixing.targets(sized).cache()
    placed = mixing.packed(sized, sources).cache()
    drawn = {(r["rank"], r.shard): (r.n, r.start) for r in mixing.shard_counts(sources, 5).collect()}
    slots = {r["rank"]: r.slots for r in sources.collect()}
    for rank, total in slots.items():
        own = [drawn[rank, s] for s in range(5) if (rank, s) in drawn]
        assert sum(n for n, _ in own) == total
        assert [start for _, start in own] == [sum(n for n, _ in own[:i]) for i in range(len(own))]
        assert len({n for n, _ in own}) > 1  # left to chance
    mix = mixing.mix(placed, sources, shards=5).collect()
    held = {(r["rank"], r.shard, r.slot) for r in mix}
    assert held == {(rank, shard, i) for (rank, shard), (n, _) in drawn.items() for i in range(n)}
    words = Counter()
    for r in mix:
        words[r["rank"], r.shard] += r.words
    for (rank, shard), (n, _) in drawn.items():
        assert 0 <= n * mixing.BLOCK - words[rank, shard] <= 3 * mixing.BLOCK  # last blocks are not full
    taken = mixing.taken(df).collect()
    assert all(bool(r.shards) == bool(r.taken) and list(r.shards) == sorted(set(r.shards)) for r in taken)


def test_equal_rows_are_mixed_each(spark):
    rows = [(1, "a b c " * 40, "s", 1)] * 9 + [(2, "d e " * 50, "t", 2)] + [(3, None, "t", 3), (3, "", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    taken = Counter()
    for r in mixing.taken(df).collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    for r in mixing.mixed(df).collect():
        got[r.doc_id] += len(r.text.split())
    assert got == Counter({i: n for i, n in taken.items() if n})


def test_many_sources_are_ordered_by_several_tasks(spark, monkeypatch):
    kept, parts = mixing.ranges, []

    def counted(*args):
        df = kept(*args)
        parts.append(df.select("_part").distinct().count())
        return df

    monkeypatch.setattr(mixing, "ranges", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, " ".join(["w"] * (i * 37 % 101)), None if i % 91 == 0 else f"s{i % 200}") for i in range(600)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        sized = df.select("source", mixing.word_count("text").alias("size"))
        got = mixing.targets(sized).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert min(parts) > 1
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    assert {r.source: r.target for r in got} == pytest.approx(expected_targets(sizes))
    assert [r.source for r in sorted(got, key=lambda r: r["rank"])] == sorted(sizes, key=lambda s: (s is None, s or ""))
