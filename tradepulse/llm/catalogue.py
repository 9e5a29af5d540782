"""The queries of the numbered operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.llm import bpe, hilbert, language, lengths, mixing, neardup, pieces, quotes, secretscan, spelling, syncmers, topk, whitening
from tradepulse.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    model = language.fit(docs.filter(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "held_out", "text"), model)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secretscan.scan(docs, secretscan.train(secretscan.samples(docs)))
    said = "concat_ws(',', transform({}, x -> concat_ws(':', x.kind, x.start, x.end)))"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(found, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in secretscan.KINDS],
        F.sha2(F.expr(said.format("filter(found, x -> x.kind <> 'markov')")), 256).alias("base_sha256"),
        F.expr(said.format("found")).alias("spans"),
    )


def op4_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lengths.histogram(lengths.encoded_lengths(docs, bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(VOCABULARY)
    ids = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(ids, ranks).select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.expr(topk.whole_numbers()).alias("v"))
    return topk.top_k(vectors, vectors.filter("id % 50 = 0"), k=5)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.sharded(table(spark, sf_dir, "documents"), shards=24)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(table(spark, sf_dir, "conversations"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), width=4, least=80)
    return found.withColumnRenamed("id", "doc_id")


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.with_edits(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(PIECES)
    ids = pieces.encode(table(spark, sf_dir, "documents"), model)
    return pieces.decode(ids, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_language": op2_language,
    "op3_secrets": op3_secrets,
    "op4_lengths": op4_lengths,
    "op5_mixing": op5_mixing,
    "op6_sharding": op6_sharding,
    "op7_quotes": op7_quotes,
    "op8_bpe": op8_bpe,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_syncmers": op10_syncmers,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_pieces": op13_pieces,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE_SQL: dict[str, str] = {
    "op1_top_k": """WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
    SELECT * FROM r WHERE rank <= 5""",
    "op9_near_duplicates": rf"""WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0) AS x),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * s >= 80 * (x.n + y.n - s)),
    e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    reach AS (SELECT a AS node, a AS r FROM e UNION SELECT reach.node, e.b FROM reach JOIN e ON reach.r = e.a),
    c AS (SELECT node, min(r) AS component FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id, d.doc_id = coalesce(c.component, d.doc_id) AS kept
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id""",
}
