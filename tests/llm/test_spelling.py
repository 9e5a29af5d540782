import random
import zlib
from collections import Counter

import pytest
import regex
from rows import empty, frame

from tradepulse.llm import catalogue, spelling

RUN = regex.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count(rows, damaged=199, shortest=6, fewest=5):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damaged == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= fewest}


def edits(word, letters):
    """Every text exactly one edit from a word."""
    found = {word[:i] + word[i + 1 :] for i in range(len(word))}
    found |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    found |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return found - {word}


def by_hand(counts, times=5):
    letters = {c for w in counts for c in w}
    near = {w: [x for x in edits(w, letters) if x in counts] for w in counts}
    best = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= times * counts[w] else None for w, b in best.items()}
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def made_words(seed=4):
    chance = random.Random(seed)
    words = ["".join(chance.choice("abcéß") for _ in range(chance.randint(6, 9))) for _ in range(60)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaabaaa", "aaaaaab", "baaaaaa", "×÷×÷×÷", "×÷×÷×÷÷"]
    for word in words[:50]:
        for _ in range(3):
            at = chance.randrange(len(word))
            words += [word[:at] + word[at + 1 :], word[:at] + "b" + word[at:], word[:at] + "c" + word[at + 1 :]]
    return [w for w in dict.fromkeys(words) if len(w) >= 6]


@pytest.mark.parametrize("seed", [4, 5])
def test_variants_equal_every_edit_tried(spark, seed):
    chance = random.Random(seed)
    counts = {w: chance.choice([5, 5, 6, 30, 31, 200, 1500]) for w in made_words(seed)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    got = [tuple(r) for r in spelling.variants(df).collect()]
    assert len(got) == len(counts) and set(got) == by_hand(counts)


def test_chains_of_forms_end_at_their_root(spark):
    word, counts = "abcdefgh", {}
    for i in range(24):
        counts[word] = 5 ** (i + 1)
        word = word[: i % 8] + "xyz"[i // 8] + word[i % 8 + 1 :]
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in spelling.variants(df).collect()}
    assert got == by_hand(counts)
    assert len({r[2] for r in got}) == 1


def test_nodes_with_one_number_make_no_neighbours(spark, monkeypatch):
    counts = {w: 5 + i for i, w in enumerate(made_words()[:60])}
    monkeypatch.setattr(spelling, "_numbers", lambda codes: spelling.np.arange(len(codes) + 1, dtype="i8") % 2)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df).collect()} == by_hand(counts)


def test_texts_of_every_kind(spark):
    chance = random.Random(9)
    words = made_words()[:80]
    rows = [(i, " ".join(chance.choice(words).upper() if i % 3 else chance.choice(words) for _ in range(60))) for i in range(80)]
    rows += [(None, "noidhere " * 7), (7, None), (8, ""), (9, "...123"), (10, "x" * 100_000), (11, "ÀÈìòù1ÀÈìòùX " * 9)]
    rows += [(20 + i, "y" * 1_000 + "z") for i in range(5)] + rows[:3]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    for damaged in (3, 199):
        counts = count(rows, damaged)
        found = spelling.word_counts(df, damaged=damaged)
        assert {r.word: r.n for r in found.collect()} == counts
        assert {tuple(r) for r in spelling.variants(found).collect()} == by_hand(counts)


def test_very_long_words_cost_numbers_only(spark):
    long = "yz" * 100_000
    df = spark.createDataFrame([(long, 50), (long[:-1], 10), (long + "z", 5), ("z" + long, 5)], "word string, n long")
    got = {len(r.word): (r.n_near, r.form == long) for r in spelling.variants(df).where("n <> 5").collect()}
    assert got == {200_000: (3, False), 199_999: (1, True)}


def test_empty_table(spark):
    assert spelling.variants(spelling.word_counts(empty(spark))).count() == 0
    assert spelling.variants(spelling.word_counts(frame(spark))).count() == 1  # "changed", of the near copies


def test_query_on_the_given_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = [tuple(r) for r in catalogue.QUERIES["op12_spelling"](spark, sf_dir).collect()]
    want = by_hand(count(rows))
    assert len(got) == len(want) and set(got) == want
