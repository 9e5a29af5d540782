"""SentencePiece encoding and decoding through tables of distinct chunks.

Spaces become markers, one more marker goes in front, and a text is cut before each run of
markers. Where no piece of the model holds a marker behind another character, no merge
crosses such a cut, so a chunk has the same ids wherever it stands. A task segments each
distinct chunk once, keeps it in a table and puts the ids of a text together from that table
by position. Texts never leave their task: a table of all chunks would have to meet every
word of the corpus in a shuffle, several times the size of the input.

Defined results: a null text counts as empty; an empty text has no ids; repeated rows and
repeated or null ids each get their row; extra columns are not looked at; a chunk of any
length is segmented whole; an empty table gives no row. A model that merges across markers,
drops white space or changes characters is refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.common import small

#: What stands for a space in pieces.
MARKER = "▁"
#: Characters of chunks that a task's table holds before it starts anew, between two texts.
TABLE = 8_000_000
#: Characters of the texts whose new chunks are segmented in one go.
GROUP = 1 << 20


def read_model(path: str) -> bytes:
    """The model file as bytes; a vocabulary, so of fixed size."""
    with open(path, "rb") as file:
        return file.read()


def _processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """Raise ValueError where chunks can't be segmented apart from each other."""
    processor = _processor(model)
    crossing = [p for p in map(processor.id_to_piece, range(len(processor))) if MARKER in p.lstrip(MARKER)]
    if crossing:
        raise ValueError(f"pieces cross white space: {crossing[:3]}")
    probe = " Aé  ﬁ　b "
    if processor.normalize(probe) != MARKER + probe.replace(" ", MARKER) or processor.piece_to_id(MARKER) == processor.unk_id():
        raise ValueError("the model changes texts before it cuts them")


class ChunkTable(dict):
    """Ids of each distinct chunk as packed 32-bit integers, segmented when first met."""

    def __init__(self, processor: sentencepiece.SentencePieceProcessor, limit: int = TABLE) -> None:
        super().__init__()
        self.processor, self.limit = processor, limit
        self.held = self.segmented = 0

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of each text. Texts are taken together up to ``GROUP`` characters, or one by one."""
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > GROUP:
                yield from self._of_group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        yield from self._of_group(group)

    def _of_group(self, texts: list[str]) -> list[bytes]:
        if self.held > self.limit:
            self.clear()
            self.held = 0
        cut = [chunks(text) if text else [] for text in texts]
        fresh = list(set().union(*cut).difference(self))
        # the model puts a chunk's first marker there itself, but not into an empty text
        found = self.processor.encode([chunk[1:] for chunk in fresh], num_threads=1)
        for chunk, ids in zip(fresh, found, strict=True):
            self[chunk] = array("i", ids if len(chunk) > 1 else [self.processor.piece_to_id(MARKER)]).tobytes()
            self.held += len(chunk)
        self.segmented += len(fresh)
        return [b"".join(map(self.__getitem__, own)) for own in cut]


def chunks(text: str) -> list[str]:
    """The chunks of a text, which is not empty: runs of markers, each with what follows."""
    return re.findall(f"{MARKER}+[^{MARKER}]*", MARKER + text.replace(" ", MARKER))


def encode(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", table: int = TABLE) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every row."""
    check_model(model)
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_type = df.schema[id_col].dataType.simpleString()

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ChunkTable(_processor(shared.value), table)
        for batch in small(batches):
            packed = list(known.ids(batch.column("text").to_pylist()))
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], names=["id", "ids"])

    rows = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInArrow(segment, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``ids_col`` and ``text``; null ids count as none."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_type = df.schema[id_col].dataType.simpleString()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(shared.value)
        for batch in small(batches):
            texts = [processor.decode(ids) if ids else "" for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ids"), pa.array(texts, pa.string())], names=["id", "ids", "text"]
            )

    picked = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    decoded = picked.mapInArrow(join, f"id {id_type}, ids array<int>, text string")
    return decoded.withColumnsRenamed({"id": id_col, "ids": ids_col})
