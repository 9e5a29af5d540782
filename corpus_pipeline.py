"""The corpus pipeline: from raw documents to token ids, one operator for each stage.

Stages run one after the other; each reads what its predecessor wrote. ``run`` applies them
to the documents table. Up to the last one they return the columns of documents, with
``n_chars`` following the text. Nulls, empty and repeated rows go by the operators' rules;
rows without an id can't be named as copies and stay.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.llm import bpe, language, mixing, neardup, secretscan
from tradepulse.llm.catalogue import VOCABULARY
from tradepulse.llm.common import table, written

#: Documents whose score is nearer than this to that of undecided classifiers are rejected: a
#: share of the way from there (0) to certainty (1), by the logarithm of the score.
LEAST_SURE = 0.5


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, if there is one, after the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: no letter, or a language that no classifier is sure of."""
    names = ("_language", "_score")
    model = language.fit(docs)
    predicted = language.predict(docs, model, into=names, keep_text=True)
    least = [F.lit(x) for lang, score in model.least_scores().items() for x in (lang, score ** (1 - LEAST_SURE))]
    if not least:
        return predicted.filter(F.lit(False)).drop(*names)
    sure = F.col(names[1]) >= F.create_map(*least)[F.col(names[0])]
    return predicted.filter((F.col(names[0]) != language.UNKNOWN) & sure).drop(*names)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near copies, the one with the smallest id stays.

    An id over different texts names none of them: each such text is told apart by a hash of
    both. Of rows alike in id and text, the smallest by all columns stays.
    """
    named = docs.filter("doc_id is not null")
    seen = named.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    shared = written(seen.filter("low <> high").select(F.col("doc_id").alias("_shared")), "shared-ids")
    own = F.when(F.col("_shared").isNull(), F.col("doc_id").cast("long")).otherwise(F.xxhash64("doc_id", "text"))
    marked = named.join(shared, F.col("doc_id") == F.col("_shared"), "left").withColumn("_node", own).drop("_shared")
    found = neardup.near_duplicates(marked, id_col="_node")
    kept = found.filter("kept").select(F.col("id").alias("_node")).distinct()
    row = F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("_row")
    rows = marked.join(kept, "_node", "left_semi").groupBy("_node").agg(row).select("_row.*")
    return rows.unionByName(docs.filter("doc_id is null"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; the documents stay."""
    return _counted(secretscan.redact(docs, secretscan.train(secretscan.samples(docs))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, with the words it takes."""
    return _counted(mixing.mixed(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and their number."""
    ids = bpe.encode(docs, bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    return ids.select("doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("encode", encode_texts),
]

#: The stages learn classifiers and encode texts, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
