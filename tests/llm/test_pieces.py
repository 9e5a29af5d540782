import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from rows import documents, empty, frame

from tradepulse.llm import catalogue, pieces

MODEL = pieces.read_model(catalogue.PIECES)


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def odd_texts():
    chance = random.Random(6)
    parts = ["a", "the", "The", " ", " ", "  ", "\n", "\t", "▁", "é", "é", "ﬁ", "漢字", "😀", "\x00", "　", "<s>", "<0x0A>", "1.5", "​", "�", " of", "ing"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 120))) for _ in range(300)]
    return [*texts, None, "", " ", "  ", "▁", "▁▁ ▁", "a ", " a", " " * 50_000, "x" * 200_000, "ab" * 9 + " " * 33, "word " * 40_000]


@pytest.mark.parametrize("limit", [0, 50, pieces.TABLE])
def test_ids_and_texts_equal_the_library(spark, processor, limit):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, [1], "x") for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>, id string").repartition(3)
    rows = pieces.decode(pieces.encode(df, MODEL, table=limit), MODEL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = processor.encode(texts[r.doc_id] or "")
        assert list(r.ids) == want and r.text == processor.decode(want)


def test_each_distinct_chunk_is_segmented_once(processor, monkeypatch):
    texts = ["one two  two one", "two one three", "", "one"]
    distinct = len({c for t in texts if t for c in pieces.chunks(t)})
    for group in (1, 15, pieces.GROUP):
        monkeypatch.setattr(pieces, "GROUP", group)
        table = pieces.ChunkTable(processor)
        assert [len(x) // 4 for x in table.ids(texts)] == [len(processor.encode(t)) for t in texts]
        assert table.segmented == len(table) == distinct == 4
    table.limit = 0  # starts anew
    assert len(list(table.ids(["one"]))) == 1 and table.segmented == 5 and len(table) == 1


def test_every_row_counts(spark, processor):
    rows = documents()
    got = pieces.encode(frame(spark, rows), MODEL).collect()
    key = lambda pair: (pair[0] is None, pair)
    want = sorted(((r[0], processor.encode(r[1] or "")) for r in rows), key=key)
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=key) == want
    assert pieces.encode(empty(spark), MODEL).count() == 0 == pieces.decode(pieces.encode(empty(spark), MODEL), MODEL).count()


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.text for r in pieces.decode(df, MODEL).collect()} == {""}


def test_query_on_the_given_table(spark, sf_dir, processor):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = catalogue.QUERIES["op13_pieces"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = processor.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(processor.decode(ids)))
