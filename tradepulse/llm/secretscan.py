"""Secret scans: fixed patterns, and Markov models of random strings and identifiers.

Two character chains are counted from labelled samples, one over random strings and one over
ordinary identifiers. A long run of token characters that no pattern covers is a secret if
the log-likelihood ratio of the chains, per character, is above a threshold.

Defined results: a null text counts as empty; spans are code points, end exclusive; repeated
rows each get their row; with no labelled sample of either kind no run is added; extra
columns are not looked at.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.common import small, written

# The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_PARTS = ("passw", "secret", "token", "api")  # one of them is in every match
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16

#: Symbols of the chains; a run of the others ends a candidate.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
IDENTIFIER = re.compile(r"[A-Za-z0-9_-]{8,}")
#: Least log-likelihood ratio for each character, in nats, and distinct symbols of a run.
THRESHOLD, DISTINCT = 1.0, 8
#: Transitions that the prior of a chain weighs; weight of an unseen symbol.
PRIOR, SMOOTHING = 4.0, 0.5
#: Documents that the sample of each label is taken from, at most.
SAMPLE_ROWS = 4000

_CODE = np.full(128, len(SYMBOLS), dtype=np.int64)
_CODE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
_SIZE = len(SYMBOLS) + 1

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the patterns, leftmost and without overlap in each kind."""
    found: list[Span] = []
    lowered = text.lower()
    if any(part in lowered for part in ASSIGN_PARTS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_VALUE:
                found.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _overlap(spans: list[Span]) -> Callable[[int, int], bool]:
    """Tells whether a stretch overlaps any of the spans; sorted once, then searched."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _ in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def overlaps(start: int, end: int) -> bool:
        at = bisect.bisect_left(starts, end) - 1
        return at >= 0 and start < ends[at]

    return overlaps


def _codes(run: str) -> np.ndarray:
    return _CODE[np.frombuffer(run.encode("ascii"), np.uint8)]


def _added(text: str, base: list[Span], ratio: np.ndarray, threshold: float) -> list[Span]:
    found = []
    overlaps = _overlap(base)
    for m in CANDIDATE.finditer(text):
        if overlaps(m.start(), m.end()):
            continue
        codes = _codes(m[0])
        if len(set(m[0])) >= DISTINCT and ratio[codes[:-1], codes[1:]].mean() > threshold:
            found.append((m.start(), m.end(), "markov"))
    return found


def _random(text: str, spans: list[Span]) -> list[str]:
    """What the patterns match in a text."""
    return [ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end] for start, end, kind in spans]


def _plain(text: str, spans: list[Span]) -> Iterator[str]:
    """The other runs of identifier characters."""
    overlaps = _overlap(spans)
    return (m[0] for m in IDENTIFIER.finditer(text) if not overlaps(m.start(), m.end()))


def samples(df: DataFrame, rows: int = SAMPLE_ROWS, text_col: str = "text") -> DataFrame:
    """Labelled strings (``value``, ``secret``), of each label from at most ``rows`` different texts.

    What the patterns match is a random string; other runs of identifier characters are
    ordinary. Of the texts of the whole table that have strings of a label, those with the
    smallest hash are taken, so a label that few texts have is sampled as well.
    """
    texts = df.select(F.col(text_col).alias("text")).filter("text is not null").withColumn("hash", F.xxhash64("text", F.lit(29)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            random, plain = [], []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                random.append(_random(text, spans))
                plain.append(any(True for _ in _plain(text, spans)))
            found = [pa.array(random, pa.list_(pa.string())), pa.array(plain, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(1), *found], names=["hash", "random", "plain"])

    # of each text, its hash and what the patterns match; identifiers are read again of a few only
    labels = texts.mapInArrow(find, "hash long, random array<string>, plain boolean").filter("size(random) > 0 or plain")
    labels = written(labels, "labels")
    last = labels.filter("plain").select("hash").distinct().orderBy("hash").limit(rows).agg(F.max("hash")).first()[0]
    secrets = labels.filter("size(random) > 0").dropDuplicates(["hash"]).orderBy("hash").limit(rows)
    of_secrets = secrets.select(F.explode("random").alias("value"), F.lit(True).alias("secret"))
    if last is None:
        return of_secrets

    def ordinary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            plain = [list(_plain(text, base_spans(text))) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(plain, pa.list_(pa.string()))], names=["hash", "plain"])

    near = texts.filter(F.col("hash") <= last).mapInArrow(ordinary, "hash long, plain array<string>")
    return of_secrets.unionByName(near.dropDuplicates(["hash"]).select(F.explode("plain").alias("value"), F.lit(False).alias("secret")))


def train(labelled: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of every transition, from labelled strings.

    Identifiers have an unseen transition as often as its symbol is common in them. Of the
    random strings one half is taken to have any symbol with the same chance, since samples
    seldom show every alphabet. Transitions are counted by Spark; at most two counts for each pair of symbols come back.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, _SIZE * _SIZE), dtype=np.int64)
        for batch in small(batches):
            for value, secret in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if value and secret is not None and value.isascii():
                    codes = _codes(value)
                    np.add.at(sums[int(secret)], codes[:-1] * _SIZE + codes[1:], 1)
        kind, pair = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int64()), pa.array(pair, pa.int64()), pa.array(sums[kind, pair], pa.int64())], names=["kind", "pair", "n"]
        )

    counts = labelled.select("value", "secret").mapInArrow(count, "kind long, pair long, n long")
    sums = np.zeros((2, _SIZE, _SIZE))
    for kind, pair, n in counts.groupBy("kind", "pair").agg(F.sum("n")).collect():
        sums[kind, pair // _SIZE, pair % _SIZE] = n
    if not sums.any(axis=(1, 2)).all():
        return np.zeros((_SIZE, _SIZE))
    common = (sums[0].sum(axis=0) + SMOOTHING) / (sums[0] + SMOOTHING / _SIZE).sum()
    prior = np.stack([np.broadcast_to(common, (_SIZE, _SIZE)), np.full((_SIZE, _SIZE), 1 / _SIZE)])
    chance = (sums + PRIOR * prior) / (sums.sum(axis=2, keepdims=True) + PRIOR)
    return np.log((chance[1] + 1 / _SIZE) / 2) - np.log(chance[0])


def scan(
    df: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col`` and ``found``: an array of (start, end, kind) by start, then kind as listed."""
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                spans += _added(text, spans, ratio, threshold)
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                found.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind_type)], names=["id", "found"])

    out = rows.mapInArrow(find, f"id {id_type}, found array<struct<start: long, end: long, kind: string>>")
    return out.withColumnRenamed("id", id_col)


def redact(df: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every span replaced by ``mark``; a null text stays null."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            at = batch.schema.get_field_index(text_col)
            texts = []
            for text in batch.column(at).to_pylist():
                if text:
                    spans = base_spans(text)
                    spans += _added(text, spans, ratio, threshold)
                    parts, done = [], 0
                    for start, end, _ in sorted(spans):
                        if start >= done:
                            parts += [text[done:start], mark]
                        done = max(done, end)
                    text = "".join(parts) + text[done:]
                texts.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return df.mapInArrow(cover, df.schema)
