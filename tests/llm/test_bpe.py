import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from rows import documents, empty, frame

from tradepulse.llm import bpe, catalogue, lengths

RANKS = bpe.read_ranks(catalogue.VOCABULARY)
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    chance = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\n\n", "'re", "'s", "'", "1", "23", "é", "漢", "😀", ".", ",", "\t", " the"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 300))) for _ in range(150)]
    return [*texts, "x" * 200, None, "", " " * 100, "a" * 40 + " " * 30 + "b" * 10, *texts[:5]]


@pytest.mark.parametrize("chunk,overlap", [(16, 16), (40, 12), (64, 64), (1 << 16, 1 << 12)])
def test_chunks_are_stitched_to_what_the_whole_gives(spark, encoding, chunk, overlap):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, RANKS, PATTERN, chunk=chunk, overlap=overlap), RANKS).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == encoding.encode_ordinary(text or "")
        assert bytes(got[i].bytes).decode() == (text or "")


def test_round_trip_of_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("want"))
    got = catalogue.QUERIES["op8_bpe"](spark, sf_dir).join(docs, "doc_id")
    assert got.count() == docs.count() == got.filter("want = decoded_sha256").count()


def check_histogram(rows, n):
    """``rows`` of a histogram against the sorted lengths themselves."""
    assert sorted(r.context_limit for r in rows) == sorted(set(n))
    for r in rows:
        limit = r.context_limit
        assert r.docs == n.count(limit) and r.docs_within == sum(x <= limit for x in n)
        assert r.docs_cut == sum(x > limit for x in n) and r.tokens_total == sum(n)
        assert r.tokens_within == sum(x for x in n if x <= limit) and r.tokens_beyond == sum(x for x in n if x > limit)
        assert r.tokens_kept == sum(min(x, limit) for x in n)
    of_row = {p: r.context_limit for r in rows for p in r.percentiles}
    assert of_row == {p: n[-(-p * len(n) // 100) - 1] for p in range(1, 101)}


def test_the_query_on_the_given_table(spark, sf_dir, encoding):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    n = sorted(len(encoding.encode_ordinary(t or "")) for t in texts)
    check_histogram(catalogue.QUERIES["op4_lengths"](spark, sf_dir).collect(), n)


@pytest.mark.parametrize("neighbours", [1, 7, 1 << 20])
def test_buckets_of_neighbours_change_nothing(spark, neighbours):
    chance = random.Random(neighbours)
    n = sorted([chance.randint(0, 40) for _ in range(90)] + [5000, 10**9, 10**9])
    df = spark.createDataFrame([(x,) for x in n] + [(None,)], "n_tokens long")
    check_histogram(lengths.histogram(df, neighbours=neighbours).collect(), [0, *n])


def test_lengths_answer_every_limit(spark, encoding):
    rows = documents()
    n = sorted(len(encoding.encode_ordinary(r[1] or "")) for r in rows)
    got = lengths.encoded_lengths(frame(spark, rows), RANKS, PATTERN)
    assert sorted(r.n_tokens for r in got.collect()) == n
    hist = lengths.histogram(got).cache()
    check_histogram(hist.collect(), n)
    for r in lengths.at_limits(hist, [0, 1, 17, 10**6]).collect():
        assert (r.docs, r.docs_cut) == (len(n), sum(x > r.limit for x in n))
        assert (r.tokens_kept, r.tokens_total) == (sum(min(x, r.limit) for x in n), sum(n))
    quantile = {r.share: r.length for r in lengths.quantiles(hist, [0.1, 0.5, 1.0]).collect()}
    assert quantile == {q: next(x for x in n if sum(y <= x for y in n) >= q * len(n)) for q in (0.1, 0.5, 1.0)}
    hist.unpersist()


def test_empty_table(spark):
    assert bpe.encode(empty(spark), RANKS, PATTERN).count() == 0
    assert lengths.histogram(lengths.encoded_lengths(empty(spark), RANKS, PATTERN)).count() == 0
