"""Spelling variants by pairs of trie nodes.

Every word is a path in a trie of the words and in one of the reversed words. A node's number
is made from its parent's number and its letter, so that all tasks number the tries alike
without holding them. For each position a word has the pair (node of what stands before it,
node of what stands behind it), once with the position's letter skipped, once without
skipping. Words with equal pairs differ by one replaced letter where both skip one, and by
one inserted letter where only the longer one does. Letters confirm each pair, so the
neighbours are exact.

The words behind one pair differ in a single letter, so no more meet than the alphabet has
letters. Rows for pairs carry numbers only, so that a word of a million letters costs as many
small rows and not as many copies.

Defined results: a null text has no words, a null id is written as an empty one; ties of n go
to the smaller word in code-point order; repeated rows count each; extra columns are not
looked at; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.common import small, written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Shortest word; fewest occurrences; how much more frequent a form is; one run in so many is damaged.
SHORTEST, FEWEST, TIMES, DAMAGED = 6, 5, 5, 199
#: Node numbers are polynomials over this field.
PRIME, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681 % ((1 << 61) - 1)
#: A form is at least five times as frequent, so that chains end within 27 steps (5 ** 28 > 2 ** 63).
DOUBLINGS = 5


def word_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, fewest: int = FEWEST,
    damaged: int | None = DAMAGED,
) -> DataFrame:
    """``word`` and ``n`` of the lower-cased words of all texts.

    With ``damaged``, a run whose checksum with its document's id is divisible by it loses one letter.
    """
    lower = F.translate(F.coalesce(text_col, F.lit("")), _UPPER, _UPPER.lower())
    found = F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.explode(found).alias("run"))
    word = F.col("run")
    if damaged is not None:
        runs = runs.withColumn("h", F.crc32(F.concat("_id", F.lit(":"), "run")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % damaged != 0, word).otherwise(_without(word, at))
    words = runs.select(word.alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= fewest)


def _without(word: Column, at: Column) -> Column:
    """``word`` without the letter at ``at``, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def _numbers(codes: list[int]) -> np.ndarray:
    """Numbers of the nodes on a path: the root first."""
    numbers = [0]
    for code in codes:
        numbers.append((numbers[-1] * BASE + code + 1) % PRIME)
    return np.array(numbers, np.int64)


def node_pairs(words: DataFrame) -> DataFrame:
    """``prefix`` and ``suffix`` nodes around each position ``at`` of every word (``w``, ``word``).

    ``letter`` is the skipped one, or -1 where none is. ``first`` marks the first of equal letters
    in a row: skipping any of them leaves the same word.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 2048):
            parts: list[tuple[np.ndarray, ...]] = []
            for w, word in zip(batch.column("w").to_pylist(), batch.column("word").to_pylist(), strict=True):
                letters = np.frombuffer(word.encode("utf-32-le"), "<i4")
                before, behind = _numbers(letters.tolist()), _numbers(letters[::-1].tolist())[::-1]
                n = len(letters)
                fresh = np.append(True, letters[1:] != letters[:-1])[:n]
                parts.append((
                    np.concatenate([before[:-1], before]), np.concatenate([behind[1:], behind]), np.full(2 * n + 1, w, np.int64),
                    np.concatenate([np.arange(n), np.arange(n + 1)]).astype(np.int32),
                    np.concatenate([letters, np.full(n + 1, -1)]).astype(np.int32), np.concatenate([fresh, np.zeros(n + 1, bool)]),
                ))
            if parts:
                columns = [pa.array(np.concatenate(column)) for column in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["prefix", "suffix", "w", "at", "letter", "first"])

    schema = "prefix long, suffix long, w long, at int, letter int, first boolean"
    return words.select("w", "word").mapInArrow(pairs, schema)


def neighbours(words: DataFrame) -> DataFrame:
    """``w`` and ``near``, the numbers of all words exactly one edit apart, in both directions.

    ``words`` has distinct ``word`` and its number ``w``, and gives the same numbers when read again.
    """
    pairs = written(node_pairs(words), "node-pairs")
    place = ["prefix", "suffix", "at"]
    skipped = pairs.where("letter >= 0")
    other = skipped.withColumnsRenamed({"w": "near", "letter": "its_letter"}).select(*place, "near", "its_letter")
    replaced = skipped.join(other, place).where("letter <> its_letter").select("w", "near", "at", F.lit(False).alias("longer"))
    unskipped = pairs.where("letter < 0").select(*place, "w")
    inserted = unskipped.join(skipped.where("first").select(*place, F.col("w").alias("near")), place)
    found = replaced.unionByName(inserted.select("w", "near", "at", F.lit(True).alias("longer")))

    text = words.select("w", "word")
    named = found.join(text, "w").join(text.withColumnsRenamed({"w": "near", "word": "its_word"}), "near")
    own = F.when(F.col("longer"), F.col("word")).otherwise(_without(F.col("word"), F.col("at")))
    confirmed = named.where(own == _without(F.col("its_word"), F.col("at"))).select("w", "near", "longer")
    back = F.explode(F.when(F.col("longer"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    both = confirmed.select("w", "near", back.alias("turned"))
    return both.select(
        F.when(F.col("turned"), F.col("near")).otherwise(F.col("w")).alias("w"),
        F.when(F.col("turned"), F.col("w")).otherwise(F.col("near")).alias("near"),
    )


def _roots(links: DataFrame) -> DataFrame:
    """``w`` and ``root`` of words with a form (``w``, ``form``): pointers are doubled until none moves."""
    pointers = written(links.select("w", F.col("form").alias("root")), "roots")
    for _ in range(DOUBLINGS):
        further = pointers.select(F.col("w").alias("root"), F.col("root").alias("further"))
        if pointers.join(further, "root", "left_semi").isEmpty():
            break
        moved = pointers.join(further, "root", "left").select("w", F.coalesce("further", "root").alias("root"))
        pointers = written(moved, "roots")
    return pointers


def variants(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every row of ``counts``."""
    words = written(counts.select(F.monotonically_increasing_id().alias("w"), "word", F.col("n").cast("long").alias("n")), "words")
    frequent = words.select(F.col("w").alias("near"), F.struct((-F.col("n")).alias("rank"), "word", F.col("w").alias("form")).alias("best"))
    nearest = neighbours(words).join(frequent, "near").groupBy("w").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    own = words.join(nearest, "w", "left")
    has_form = -F.col("best.rank") >= times * F.col("n")
    found = written(
        own.select(
            "w", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best.form")).alias("f"), F.when(has_form, F.col("best.word")).alias("form"),
            F.when(has_form, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where("f is not null").select("w", F.col("f").alias("form")))
    named = roots.join(words.select(F.col("w").alias("root"), F.col("word").alias("_root")), "root").select("w", "_root")
    return found.join(named, "w", "left").select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
