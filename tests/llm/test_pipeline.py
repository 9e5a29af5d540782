import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from rows import documents, empty, frame
from test_mixing import expected_targets
from test_neardup import brute

import corpus_pipeline
from tradepulse.llm import bpe, catalogue, mixing


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What every stage returns on the given table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        rows = found.collect()
        assert found.columns == docs.columns or _ == "encode"
        out.append(rows)
        docs = spark.createDataFrame(rows, found.schema)
    return out


def test_language_stage_keeps_whatever_has_letters(stages):
    assert sorted(r.doc_id for r in stages[1]) == sorted(r.doc_id for r in stages[0] if re.search(r"[^\W\d_]", r.text or ""))


def test_one_document_of_each_group_stays(stages):
    want = brute([(r.doc_id, r.text) for r in stages[1]], 5)
    assert sorted(r.doc_id for r in stages[2]) == sorted(set(want.values()))


def test_secrets_are_covered(spark, sf_dir, stages):
    before = {r.doc_id: r.text for r in stages[2]}
    assert sorted(before) == sorted(r.doc_id for r in stages[3])
    assert not any(re.search(r"[0-9a-f]{32}|AKIA[A-Z0-9]{12}", r.text) for r in stages[3])
    rows = [(1, "my token=abcdefghij1 and more", 29), (2, "clean text", 10), (3, "0123456789abcdef" * 3, 48), (4, None, None)]
    out = dict(corpus_pipeline.STAGES)["secrets"](spark, spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), sf_dir)
    assert {tuple(r) for r in out.collect()} == {(1, "my [secret] and more", 20), (2, "clean text", 10), (3, "[secret]", 8), (4, None, None)}


def test_mix_meets_its_targets(stages):
    count = lambda text: len(re.findall(mixing.WORD, text))
    sizes, taken, own, mixed = Counter(), Counter(), Counter(), Counter()
    for r in stages[3]:
        sizes[r.source] += count(r.text)
        own[r.doc_id] += count(r.text)
    for r in stages[4]:
        taken[r.source] += count(r.text)
        mixed[r.doc_id] += count(r.text)
        assert r.n_chars == len(r.text)
    for source, words in expected_targets(sizes).items():
        assert abs(taken[source] - words) <= mixing.BLOCK
    assert all(mixed[i] <= 3 * own[i] for i in mixed)


def test_ids_decode_to_the_texts(stages):
    ranks = bpe._vocabulary(bpe.read_ranks(catalogue.VOCABULARY))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((r.doc_id, tuple(encoding.encode_ordinary(r.text))) for r in stages[4])
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in stages[5]) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in stages[5])


def test_run_gives_the_same(spark, sf_dir, stages):
    got = Counter((r.doc_id, bytes(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == Counter((r.doc_id, bytes(r.ids)) for r in stages[5])


def test_odd_rows_and_an_empty_table(spark, sf_dir):
    for docs in (frame(spark, documents()), empty(spark)):
        start = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.schema.simpleString() == docs.schema.simpleString(), name
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
        assert (docs.count() > 0) == (start > 0)


UNLEARNED = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "qxz zzkq wvwx qqjx kzxv jjqw xkcd vbnm zxcv qwrt ghjk plkm nbvc xzlk jhgf dsaq",
]


def test_language_stage_rejects_what_no_classifier_is_sure_of(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(UNLEARNED)], docs.schema)
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["language"](spark, docs.unionByName(odd), sf_dir).collect()}
    assert kept == {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}


def test_language_stage_keeps_all_letters_of_a_single_language(spark, sf_dir):
    docs = spark.createDataFrame([(1, "hello there", "en"), (2, "12", "en"), (3, None, "en")], "doc_id long, text string, lang string")
    assert [r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, sf_dir).collect()] == [1]
    assert corpus_pipeline.keep_known_languages(spark, docs.filter("text is null"), sf_dir).count() == 0


def test_texts_under_one_id_are_told_apart(spark, sf_dir):
    texts = [" ".join(f"{c}{k}" for k in range(60)) for c in "abc"]
    near = texts[0].replace("a59", "other")
    rows = [(1, texts[0], "en"), (1, texts[1], "en"), (1, texts[1], "de"), (1, texts[1], "de"), (2, near, "en"), (3, texts[2], None), (3, texts[2], None), (None, texts[2], None), (None, None, None)]
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    results = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)
        results.append(sorted(map(tuple, stage(spark, docs, sf_dir).collect()), key=str))
    assert results[0] == results[1]
    kept = [r for r in results[0] if r[0] is not None]
    assert len(results[0]) - len(kept) == 2
    assert sorted(r[1] for r in kept if r[1] not in (texts[0], near)) == [texts[1], texts[2]]
    assert sum(r[1] in (texts[0], near) for r in kept) == 1
    assert ("de" in {r[2] for r in kept}) and len(kept) == 3
