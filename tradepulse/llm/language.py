"""Language ID by hierarchical discrimination.

First the language family is predicted, then linear support vector machines, one for each
pair, separate the languages of that family. All of them see hashed byte 2- and 3-grams of
the lower-cased letters of the whole text. Training rows are a bounded sample of each
language, and each classifier is fitted by a task of its own; prediction reads every text
once, where it lies.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing was learned; a single learned language has score 1 wherever there are
letters; ties go to the language first by name; repeated rows each get their row; extra
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.llm.common import STEPS, small, written

UNKNOWN = "und"
#: Texts of each language that the classifiers are fitted on, at most.
TRAINING_TEXTS = 400
#: Buckets of the hashed n-grams; characters looked at together, so that long texts stay small.
BUCKETS, SLICE = 1 << 13, 1 << 20

# Language families by ISO 639-1 code. Any other code is a family of its own.
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "bg": "slavic", "cs": "slavic", "pl": "slavic", "ru": "slavic", "uk": "slavic",
}

_LETTER = regex.compile(r"\p{L}")
#: Bytes kept as they are: letters, and whatever belongs to a character beyond ASCII.
_KEPT = np.full(256, 32, dtype=np.uint32)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)


def grams(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(len(text), 1), SLICE):
        piece = text[at : at + SLICE].lower().encode("utf-8", "replace")
        b = _KEPT[np.frombuffer(b" " + piece + b" ", np.uint8)]
        pairs = (b[:-1] << np.uint32(8)) | b[1:]
        triples = (pairs[:-1] << np.uint32(8)) | b[2:]
        for codes, odd in ((pairs, 0x9E3779B1), (triples, 0x85EBCA6B)):
            counts += np.bincount((codes * np.uint32(odd)) >> np.uint32(32 - 13), minlength=BUCKETS)
    return counts


def features(counts: np.ndarray) -> np.ndarray:
    """Root of the relative frequencies: of length 1, and common n-grams don't drown the rest."""
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


def svm(x: np.ndarray, sign: np.ndarray, cost: float = 10.0, rounds: int = 40) -> np.ndarray:
    """Weights (the last one is the bias) of a linear support vector machine, by dual ascent.

    The classes weigh the same, however many rows each has.
    """
    gram = (x @ x.T).astype(np.float64) + 1  # the bias is a feature that is always 1
    most = np.where(sign > 0, cost / max((sign > 0).mean(), 1e-9), cost / max((sign < 0).mean(), 1e-9)) / 2
    alpha, margin, order = np.zeros(len(x)), np.zeros(len(x)), np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            new = min(max(alpha[i] + (1 - sign[i] * margin[i]) / gram[i, i], 0.0), most[i])
            if new != alpha[i]:
                margin += (new - alpha[i]) * sign[i] * gram[i]
                alpha[i] = new
    weight = alpha * sign
    return np.append(weight.astype(np.float32) @ x, weight.sum())


@dataclass
class Duel:
    """One classifier for each pair of names; the name with most won pairs is chosen."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    @classmethod
    def of(cls, names: list[str], weights: dict[tuple[str, str], np.ndarray]) -> Duel:
        pairs = list(combinations(range(len(names)), 2))
        rows = [weights[names[a], names[b]] for a, b in pairs]
        return cls(names, pairs, np.array(rows).reshape(len(pairs), BUCKETS + 1))

    def choose(self, x: np.ndarray) -> tuple[str, float]:
        """The chosen name, and the mean chance of it over its pairs."""
        if not self.pairs:
            return self.names[0], 1.0
        chance = 1 / (1 + np.exp(-np.clip(2 * (self.weights[:, :-1] @ x + self.weights[:, -1]), -30, 30)))
        won, sure = np.zeros(len(self.names)), np.zeros(len(self.names))
        for (a, b), p in zip(self.pairs, chance, strict=True):
            won[a if p >= 0.5 else b] += 1
            sure[a] += p
            sure[b] += 1 - p
        best = max(range(len(self.names)), key=lambda i: (won[i], sure[i], -i))
        return self.names[best], float(sure[best] / (len(self.names) - 1))


@dataclass
class Model:
    family: Duel | None
    within: dict[str, Duel]

    def predict(self, text: str | None) -> tuple[str, float]:
        if self.family is None or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0
        x = features(grams(text))
        family, sure = self.family.choose(x)
        language, chance = self.within[family].choose(x)
        return language, sure * chance

    def least_scores(self) -> dict[str, float]:
        """By language: the score of a document for which every classifier is undecided."""
        half = lambda duel: 0.5 if duel.pairs else 1.0
        return {lang: half(self.family) * half(duel) for duel in self.within.values() for lang in duel.names}


def fit(
    df: DataFrame, per_language: int = TRAINING_TEXTS, text_col: str = "text", lang_col: str = "lang",
    families: dict[str, str] = FAMILIES,
) -> Model:
    """Fit on at most ``per_language`` different texts of each non-null language.

    The texts with the smallest hash are taken, so the sample does not depend on the layout.
    A task has the n-gram counts of one pair: those of two languages, or of the languages of
    two families. Only weights come to the driver, 64 KB for each pair, as the model has them.
    """
    rows = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    hashed = rows.withColumn("key", F.xxhash64("text", F.lit(41)))
    # different texts, as copies are learned from once; one number for each language comes
    # back, as the model itself has, and no text is shuffled for it
    counts = {row["lang"]: row["count"] for row in hashed.select("lang", "key").distinct().groupBy("lang").count().collect()}
    if not counts:
        return Model(None, {})
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 2.0 * STEPS * per_language / n)])
    near = hashed.filter(F.pmod("key", F.lit(STEPS)) <= share[F.col("lang")]).dropDuplicates(["lang", "key"])
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            kept = [grams(text) for text in batch.column("text").to_pylist()]
            found = [np.flatnonzero(x) for x in kept]
            numbers = [x[f] for x, f in zip(kept, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("key"), pa.array(found, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int64()))],
                names=["lang", "key", "gram", "n"],
            )

    chosen = ranked.filter(F.col("rank") <= per_language).select("lang", "key", "text")
    counted = written(chosen.repartition("lang", "key").mapInArrow(count, "lang string, key long, gram array<int>, n array<long>"), "grams")
    # again a number for each language: what was chosen may lack one whose hashes are all large
    family_of = {row["lang"]: families.get(row["lang"], row["lang"]) for row in counted.select("lang").distinct().collect()}
    members = {f: sorted(x for x in family_of if family_of[x] == f) for f in sorted(set(family_of.values()))}
    weights = _fitted(counted, members)
    duel = lambda level, names: Duel.of(names, {k[1:]: w for k, w in weights.items() if k[0] == level})
    return Model(duel("family", list(members)), {f: duel("language", names) for f, names in members.items()})


def _fitted(counted: DataFrame, members: dict[str, list[str]]) -> dict[tuple[str, str, str], np.ndarray]:
    """Weights by level and the two names that a classifier tells apart, each fitted in a task."""
    sides = [
        ("family", a, b, lang, sign) for a, b in combinations(members, 2) for side, sign in ((a, 1), (b, -1)) for lang in members[side]
    ] + [
        ("language", a, b, lang, sign) for names in members.values() for a, b in combinations(names, 2) for lang, sign in ((a, 1), (b, -1))
    ]
    if not sides:
        return {}

    def fit_pair(rows: pa.Table) -> pa.Table:
        # rows came in whatever order: sort them, so that the fit is the same each time
        rows = rows.combine_chunks().sort_by([("lang", "ascending"), ("key", "ascending")])
        x = np.zeros((rows.num_rows, BUCKETS), np.float32)
        for i in range(rows.num_rows):
            dense = np.zeros(BUCKETS, dtype=np.int64)
            dense[rows["gram"][i].values.to_numpy()] = rows["n"][i].values.to_numpy()
            x[i] = features(dense)
        weight = svm(x, rows["sign"].to_numpy().astype(np.float64))
        names = [rows.column(c).slice(0, 1).combine_chunks() for c in ("level", "a", "b")]
        return pa.Table.from_arrays([*names, pa.array([weight.astype("<f8").tobytes()], pa.binary())], names=["level", "a", "b", "weight"])

    asked = counted.sparkSession.createDataFrame(sides, "level string, a string, b string, lang string, sign int")
    fitted = counted.join(asked, "lang").groupBy("level", "a", "b").applyInArrow(fit_pair, "level string, a string, b string, weight binary")
    return {(r.level, r.a, r.b): np.frombuffer(r.weight, "<f8") for r in fitted.collect()}


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from; a null id is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def predict(
    df: DataFrame, model: Model, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "score"), keep_text: bool = False
) -> DataFrame:
    """``df`` with the predicted language and its score; the text goes, unless it is to be kept.

    Columns of these names in ``df`` are replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in into and (keep_text or f.name != text_col)]
    names = [f.name for f in kept]
    rows = df.select(*names) if keep_text else df.select(*names, text_col)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [model.predict(text) for text in batch.column(text_col).to_pylist()]
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *added], names=[*names, *into])

    schema = type(df.schema)([*kept]).add(into[0], "string").add(into[1], "double")
    return rows.mapInArrow(label, schema)
