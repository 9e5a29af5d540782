import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F
from rows import documents, empty, frame

from tradepulse.llm import catalogue, syncmers


def edits(rows):
    """By id: the texts of an id, and the text that follows it."""
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0))
    texts = {i: [t or "" for j, t in rows if j == i] for i in ids}
    follower = {a: texts[b] for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}
    return texts, follower


def check(rows, got):
    assert len(got) == len(rows)
    texts, follower = edits(rows)
    for r in got:
        possible = {
            (len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest())
            for t in texts[r.doc_id]
            for n in follower[r.doc_id]
        }
        assert (r.n_chars, r.edited_sha256) in possible
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_given_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = catalogue.QUERIES["op10_syncmers"](spark, sf_dir).collect()
    check(rows, got)
    prints, text = {}, dict(rows)
    for r in got:
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in got if r.n_chars > 400 and r.fingerprint != r.edited_fingerprint]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)
    assert sum(0.1 < r.near_edited < 0.8 for r in long) > 0.9 * len(long)


def test_odd_rows(spark):
    rows = documents()
    check([(r[0], r[1]) for r in rows], syncmers.with_edits(frame(spark, rows)).collect())
    assert syncmers.with_edits(empty(spark)).count() == 0
    alone = syncmers.with_edits(spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0


def test_anchors_are_those_of_the_definition(spark):
    """Brute force over the hashes, and the same anchors wherever a passage stands."""
    words = [f"w{i * i % 97}" for i in range(200)]
    texts = [" ".join(words), "x y z " + " ".join(words) + " end"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    pairs = spark.createDataFrame([(i, words[i], words[i + 1]) for i in range(199)], "i int, a string, b string")
    h = [r.h for r in pairs.orderBy("i").select(F.xxhash64("a", "b", F.lit(1)).alias("h")).collect()]
    want = {i for i in range(len(h) - 3) if min(h[i], h[i + 3]) == min(h[i : i + 4])}
    found = syncmers.anchors(df).collect()
    first = {(r.position, r.hash) for r in found if r.doc_id == 0}
    assert {p for p, _ in first} == want
    assert {(p + 3, x) for p, x in first} <= {(r.position, r.hash) for r in found if r.doc_id == 1}


def likenesses(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    near = syncmers.match(*[syncmers.firsts(syncmers.anchors_of(F.col(c))) for c in ("a", "b")])["near"]
    return [r.near for r in df.orderBy("i").select(near.alias("near")).collect()]


def test_likeness_across_256_characters_and_without_spaces(spark):
    words = " ".join(f"w{i * i % 97}" for i in range(70))
    unspaced = "".join(chr(0x4E00 + i * i % 1999) for i in range(300))
    pairs = [(words[:250], words[:260]), (words[:190], words[:260]), (unspaced, unspaced[:150] + unspaced[:150][::-1]), (unspaced[:250], unspaced[:260])]
    border, cut, half, line = likenesses(spark, pairs)
    assert border > 0.8 and cut > 0.5 and half > 0.2 and line > 0.8


def test_every_text_with_a_word_has_an_anchor(spark):
    texts = [" ".join(f"{seed}{chr(97 + i)}" for i in range(n)) for n in range(1, 9) for seed in range(40)]
    texts += [" ".join(f"{seed}{chr(97 + i) * 60}" for i in range(n)) for n in range(1, 9) for seed in range(10)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert df.select(F.min(F.size(syncmers.anchors_of(F.col("text"))))).first()[0] > 0


def test_likeness_counts_all_anchors_and_where_they_lie(spark):
    """A short passage that two long texts share is found, and equals brute force over anchors()."""
    chance = random.Random(5)
    texts = [[f"{i}{chance.randrange(10**6)}" for _ in range(3000)] for i in "abc"]
    passage = [f"p{i}" for i in range(60)]
    texts[0][1000:1060], texts[1][2000:2060] = passage, passage
    texts[2][50:60] = texts[2][40:50]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    edited = [(i, t[: len(t) - len(t) // 2] + rows[(i + 1) % 3][1][: len(t) // 2]) for i, t in rows]
    found = [{}, {}]
    for first, table in zip(found, (df, spark.createDataFrame(edited, df.schema)), strict=True):
        for r in syncmers.anchors(table).orderBy("doc_id", "position").collect():
            first.setdefault(r.doc_id, {}).setdefault(r.hash, r.position)
    got = {r.doc_id: r for r in syncmers.with_edits(df).collect()}
    for i, own in found[0].items():
        for other, near, aligned in ((found[1][i], "near_edited", "aligned_edited"), (found[0][(i + 1) % 3], "near_next", "aligned_next")):
            shifts = Counter(other[h] - own[h] for h in own.keys() & other.keys())
            assert got[i][near] == sum(shifts.values()) / len(own.keys() | other.keys())
            assert got[i][aligned] == max(shifts.values(), default=0)
        assert got[i].sketch == ",".join(f"{h % 2**64:x}" for h in sorted(own)[: syncmers.KEPT])
    assert 0 < got[0].near_next < 0.02 and got[0].aligned_next > 15 and got[1].near_next == 0


def test_fingerprint_depends_on_all_anchors(spark):
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(words[:at] + ["changed"] + words[at:]) for at in range(0, 3000, 100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert syncmers.with_edits(df).select("fingerprint").distinct().count() == len(texts)
