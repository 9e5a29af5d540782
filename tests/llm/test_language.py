import zlib

import numpy as np
from rows import documents, empty, frame

from tradepulse.llm import catalogue, language


def test_held_out_accuracy_of_the_given_table(spark, sf_dir):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = catalogue.QUERIES["op2_language"](spark, sf_dir).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_seen(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    from pyspark.sql import functions as F

    held = language.held_out()
    wrong = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    model = language.fit(wrong.filter(~held), per_language=50)
    assert "xx" not in {name for duel in model.within.values() for name in duel.names}
    again = language.fit(wrong.repartition(3).filter(~held), per_language=50)
    assert np.allclose(model.family.weights, again.family.weights)


def test_odd_rows(spark):
    rows = documents()
    df = frame(spark, rows)
    model = language.fit(df)
    got = language.predict(df.select("doc_id", "text", "lang", "score"), model)
    assert got.columns == ["doc_id", "lang", "lang_pred", "score"]
    seen = got.collect()
    assert len(seen) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in seen:
        letters = any(c.isalpha() for c in text[r.doc_id] or "")
        assert (r.lang_pred == "und") == (not letters)
    assert language.fit(empty(spark)).predict("hello") == ("und", 0.0)
    one = spark.createDataFrame([(1, "hello there", "en"), (2, None, "de"), (3, "x", None)], "doc_id long, text string, lang string")
    assert language.fit(one).predict("hello") == ("en", 1.0)
    assert language.predict(empty(spark), model).count() == 0


def test_a_long_text_is_read_to_its_end():
    start, end = language.grams("a" * 3_000_000), language.grams("a" * 3_000_000 + "zq")
    assert start.sum() != end.sum() and (start != end).any()


def test_copies_do_not_shrink_the_sample(spark):
    """Few texts with many copies are all learned from, as their hashes are few."""
    words = {"en": "the house and garden", "de": "das haus und der garten", "fr": "la maison et le jardin"}
    texts = [(f"{text} {'abcdefghij'[i]}", lang) for lang, text in words.items() for i in range(10)]
    many = spark.range(3000).crossJoin(spark.createDataFrame(texts, "text string, lang string")).drop("id")
    model = language.fit(many, per_language=10)
    assert {name for duel in model.within.values() for name in duel.names} == set(words)
    once = language.fit(spark.createDataFrame(texts, "text string, lang string"), per_language=10)
    assert np.array_equal(model.family.weights, once.family.weights)


def test_pairs_are_told_apart_by_their_own_rows_alone(spark):
    """Each classifier is that of its two sides, as a plain fit on the same rows has it."""
    words = {"en": "the house and garden", "de": "das haus und der garten", "nl": "het huis en de tuin", "fr": "la maison et le jardin", "xx": "qo zu vek"}
    texts = [(f"{text} {'abcdefgh'[i]}", lang) for lang, text in words.items() for i in range(8)]
    df = spark.createDataFrame(texts, "text string, lang string")
    model = language.fit(df.repartition(4))
    assert list(model.within) == model.family.names == ["germanic", "romance", "xx"]
    assert model.within["germanic"].names == ["de", "en", "nl"] and not model.within["xx"].pairs
    keys = {(r.lang, r.text): r.key for r in df.selectExpr("*", "xxhash64(text, 41) as key").collect()}

    def plain(first, second):
        rows = sorted((lang, keys[lang, text], text) for text, lang in texts if lang in (*first, *second))
        x = np.array([language.features(language.grams(text)) for _, _, text in rows])
        return language.svm(x, np.array([1.0 if lang in first else -1.0 for lang, *_ in rows]))

    assert np.allclose(model.within["germanic"].weights[1], plain(["de"], ["nl"]))
    assert np.allclose(model.family.weights[0], plain(["de", "en", "nl"], ["fr"]))
    assert all(model.predict(f"{text} k")[0] == lang for lang, text in words.items())
