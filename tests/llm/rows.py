"""A small documents table with every odd case, and the shape of an empty one."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size long, rank int, score double"


def documents(n: int = 60, seed: int = 3) -> list[tuple]:
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(chance.choice(words) for _ in range(chance.randint(1, 90))) for _ in range(n)]
    texts += [None, "", "   ", "\t\n", "one", "One two", "a b c d", "..., 12 !!", "é漢😀 x\x0by"]
    texts += [" ".join(chance.choice(words) for _ in range(9000))]
    base = texts[:8]
    for text in base:  # near copies, and exact ones
        parts = text.split()
        parts[len(parts) // 2] = "changed"
        texts += [" ".join(parts), text, text.upper()]
    rows = []
    for i, text in enumerate(texts):
        source = None if i % 11 == 0 else f"s{i % 5}" if i % 3 else "hot"
        lang = None if i % 7 == 0 else ("en", "de", "fr")[i % 3]
        rows.append((i * 3, text, lang, source, None if text is None else len(text), "x", -1, 0, 0.5))
    rows.append((None, "no id here at all", None, None, None, None, None, None, None))
    rows += rows[:2]  # repeated rows
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
