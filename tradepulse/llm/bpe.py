"""Byte-level BPE by overlapping chunks, and decoding.

A text longer than a chunk is cut into chunks that overlap. Each chunk is pre-tokenised on
its own, from its first character, wherever that falls. Two neighbours see the same
characters in their overlap; from the first boundary that both find there on, they agree,
and there they are stitched. The pre-tokens between two stitches are then encoded, chunk by
chunk, by the ranks, and the ids of a text are put together in order. A chunk pair that never agrees
(one pre-token longer than the overlap) has its text encoded in one piece.

Defined results: a null text counts as empty; an empty text has no ids; repeated rows and
repeated ids each get their row; extra columns are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.llm.common import small

#: Characters of a chunk, and of what it shares with the next one.
CHUNK, OVERLAP = 1 << 16, 1 << 12
#: A boundary this close to the cut end of a chunk may move once more text is seen.
UNSURE = 8


def read_ranks(path: str) -> bytes:
    """The rank file as bytes; a vocabulary, so of fixed size."""
    with open(path, "rb") as file:
        return file.read()


def _vocabulary(rank_file: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in rank_file.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _encoder(rank_file: bytes, pattern: str) -> Callable[[str], bytes]:
    """Text to its ids, packed as little-endian unsigned 32-bit integers."""
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_vocabulary(rank_file), special_tokens={})
    return lambda text: np.array(encoding.encode_ordinary(text), "<u4").tobytes()


def sync_point(pattern: regex.Pattern, text: str, chunk: int, last: int) -> int:
    """First boundary from ``chunk`` to ``last`` that both neighbours find; -1 if there is none.

    Only the end of a pre-token without white space at its end will do: no later character
    can change what stands before it.
    """
    own = {m.end() for m in pattern.finditer(text)}
    theirs = [chunk, *(m.end() for m in pattern.finditer(text, chunk))]
    return next((at for at in theirs if at in own and at <= last and not text[at - 1].isspace()), -1)


def encode(
    df: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``id_col`` and ``ids`` (binary: little-endian unsigned 32-bit integers) of every row."""
    ranks = df.sparkSession.sparkContext.broadcast(rank_file)
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in small(batches):
            ids = [encoder(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["id", "ids"])

    short = rows.filter(F.length("text") <= chunk).mapInArrow(whole, f"id {id_type}, ids binary")

    long = rows.filter(F.length("text") > chunk).withColumn("digest", F.sha2("text", 256))
    texts = long.groupBy("digest").agg(F.first("text").alias("text")).withColumn("n", F.length("text"))
    cut = (
        texts.select("digest", "n", "text", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {chunk}"))).alias("c"))
        .select("digest", "n", F.col("c").cast("int").alias("c"), F.expr(f"substring(text, int(c * {chunk} + 1), {chunk + overlap})").alias("text"))
        .repartition("digest", "c")
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in small(batches):
            stops = []
            for n, c, text in zip(*(batch.column(k).to_pylist() for k in ("n", "c", "text")), strict=True):
                if (c + 1) * chunk >= n:
                    stops.append(n)
                else:
                    ends = c * chunk + len(text) >= n  # then nothing at its end is unsure
                    at = sync_point(compiled, text, chunk, len(text) - (0 if ends else UNSURE))
                    stops.append(c * chunk + at if at >= 0 else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("c"), pa.array(stops, pa.int64())], names=["digest", "c", "stop"]
            )

    stops = cut.mapInArrow(find, "digest string, c int, stop long")
    of_text = Window.partitionBy("digest")
    stitched = stops.withColumn("start", F.lag("stop", 1, 0).over(of_text.orderBy("c"))).withColumn(
        "agree", F.count("stop").over(of_text) == F.count(F.lit(1)).over(of_text)
    )
    pieces = (
        cut.join(stitched, ["digest", "c"])
        .filter("agree")
        .select("digest", "c", "text", (F.col("start") - F.col("c") * chunk).alias("start"), (F.col("stop") - F.col("c") * chunk).alias("stop"))
    )
    apart = stitched.filter(~F.col("agree")).select("digest").distinct()
    rest = texts.join(apart, "digest", "left_semi").select(
        "digest", F.lit(0).alias("c"), "text", F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("stop")
    )

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in small(batches):
            spans = zip(*(batch.column(k).to_pylist() for k in ("text", "start", "stop")), strict=True)
            ids = [encoder(text[start:stop]) for text, start, stop in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("c"), pa.array(ids, pa.binary())], names=["digest", "c", "ids"]
            )

    encoded = pieces.unionByName(rest).mapInArrow(between, "digest string, c int, ids binary")
    whole_texts = encoded.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("c", "ids"))).alias("parts"))
    joined = long.select("id", "digest").join(
        whole_texts.select("digest", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids")), "digest"
    )
    return short.unionByName(joined.select("id", "ids")).withColumnRenamed("id", id_col)


def decode(df: DataFrame, rank_file: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``ids_col`` and ``bytes``: the raw bytes of the ids, concatenated."""
    ranks = df.sparkSession.sparkContext.broadcast(rank_file)
    id_type = df.schema[id_col].dataType.simpleString()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: piece for piece, rank in _vocabulary(ranks.value).items()}.__getitem__
        for batch in small(batches):
            raw = [b"".join(map(token, np.frombuffer(x or b"", "<u4").tolist())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["id", "ids", "bytes"]
            )

    picked = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    decoded = picked.mapInArrow(join, f"id {id_type}, ids binary, bytes binary")
    return decoded.withColumnsRenamed({"id": id_col, "ids": ids_col})
