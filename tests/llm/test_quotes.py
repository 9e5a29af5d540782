import random
import re
import time

import pytest
import regex

from tradepulse.llm import quotes

TURNS = "conv_id long, turn long, role string, text string, conv string, place long"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", -1) for r in rows], TURNS).repartition(4)
    return sorted(quotes.linked(df).collect(), key=lambda r: (str(r.conv_id), r.place))


def test_nested_quotes_are_linked_and_taken_out(spark):
    rows = [
        (1, 0, "a", "Where is it?\nI looked\neverywhere."),
        (1, 1, "b", "Something else."),
        (1, 2, "c", "> Something   ELSE.\n\nI see."),
        (1, 3, "d", "> I looked\n> everywhere.\nunder the bed"),
        (1, 4, "e", "> > Something else.\n> I see.\nGood."),
        (1, 5, "f", "> never said\nok"),
        (2, 0, "a", "I see."),
    ]
    got = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert [got[1, t].reply_to for t in range(6)] == [None, None, 1, None, 2, None]
    assert [got[1, t].n_quotes for t in range(6)] == [0, 0, 1, 1, 2, 1]
    assert [got[1, t].n_linked for t in range(6)] == [0, 0, 1, 0, 2, 0]
    assert [got[1, t].thread for t in range(6)] == [0, 1, 1, 3, 1, 5]
    assert [r.turn for r in run(spark, rows) if r.conv_id == 1] == [0, 1, 2, 4, 3, 5]
    assert got[1, 2].text == "I see." and got[1, 4].text == "Good." and got[1, 0].text.startswith("Where")
    assert got[2, 0].reply_to is None


def test_rewrapped_paragraphs_and_copies_link_to_the_first(spark):
    rows = [(1, t, "u", "one two\nthree") for t in range(4)] + [(1, 9, "v", "> one\n> two three\n>\n> gone\nyes")]
    got = run(spark, rows)[-1]
    assert (got.turn, got.reply_to, got.n_quotes, got.n_linked, got.text, got.thread) == (9, 0, 2, 1, "yes", 0) or got.turn == 3
    last = next(r for r in run(spark, rows) if r.turn == 9)
    assert (last.reply_to, last.n_quotes, last.n_linked, last.text) == (0, 2, 1, "yes")


def test_odd_rows(spark):
    rows = [(None, 0, None, "hello"), (None, 1, None, "> hello"), (1, None, "a", "> x\ny"), (1, 0, "a", None), (1, 1, "a", ""), (1, 1, "a", ""), (1, 2, "b", ">>> deep")]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert sorted(r.place for r in got if r.conv_id == 1) == [0, 1, 2, 3, 4]
    own = {(r.conv_id, r.turn): r for r in got}
    assert own[None, 1].reply_to == 0 and own[None, 1].text == ""
    assert own[1, 0].text is None and own[1, None].text == "y" and own[1, 2].text == ""
    assert quotes.linked(spark.createDataFrame([], TURNS)).count() == 0


def test_without_quotes_order_is_that_of_turns(spark, sf_dir):
    got = quotes.linked(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/conversations.parquet").count()
    by_conversation = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.place)):
        by_conversation.setdefault(r.conv_id, []).append((r.thread, r.turn))
    assert all(v == sorted(v) for v in by_conversation.values())


WHITE = " \t\n\x0b\f\r"


def taken_apart(text):
    out = []
    for line in re.split(r"\r\n|\n|\r", text):
        at = level = 0
        while m := re.match(r"[ \t]{0,3}>", line[at:]):
            at, level = at + m.end(), level + 1
        at += bool(level) and line[at : at + 1] in (" ", "\t")
        out.append((level, line[at:], not line[at:].strip(WHITE)))
    return out


def passages_of(split):
    found, before = [], None
    for level, body, blank in split:
        if blank:
            before = None
        elif before == level:
            found[-1][1].append(body)
        else:
            found.append((level, [body]))
            before = level
    return [(level, regex.sub(r"[ \t\n\x0b\f\r\p{Z}]+", " ", " ".join(b).lower()).strip(" ")) for level, b in found]


def by_hand(rows):
    """Per row: reply_to, n_quotes, n_linked, thread, text. Turns must be distinct in a conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        split = {turn: taken_apart(text) for c, turn, _, text in rows if c == conv}
        if not any(level for s in split.values() for level, _, _ in s):
            out |= {(conv, t): (None, 0, 0, t, text) for c, t, _, text in rows if c == conv}
            continue
        found, first = {t: passages_of(s) for t, s in split.items()}, {}
        for turn in sorted(found):
            for level, passage in found[turn]:
                if not level:
                    first.setdefault(passage, turn)
        thread = {t: t for t in found}
        rest = {}
        for turn in sorted(found):
            quoted = [p for level, p in found[turn] if level]
            met = [first[p] for p in quoted if first.get(p, turn) < turn]
            rest[turn] = (max(met, default=None), len(quoted), len(met))
            if met:
                old, new = thread[turn], thread[max(met)]
                thread = {t: min(old, new) if v in (old, new) else v for t, v in thread.items()}
        for c, turn, _, text in rows:
            if c == conv:
                own = [body for level, body, _ in split[turn] if not level]
                while own and not own[0].strip(WHITE):
                    own.pop(0)
                out[conv, turn] = (*rest[turn], thread[turn], "\n".join(own).rstrip(WHITE) if rest[turn][1] else text)
    return out


def generated(seed, conversations=12, turns=14):
    chance = random.Random(seed)
    words = ["one", "Two", "three", "é", "x>y", "a\x85b", "p q", "  indented", "> not", "end  "]
    rows = []
    for conv in range(conversations):
        texts = []
        for turn in range(turns):
            parts = []
            for _ in range(chance.randint(1, 4)):
                if texts and chance.random() < 0.6:
                    mark = chance.choice(["> ", ">", ">\t", " > ", "   >  "])
                    quoted = chance.choice(texts).split("\n")
                    parts.append("\n".join(mark + line for line in quoted[: chance.randint(1, len(quoted))]))
                else:
                    parts.append("\n".join(" ".join(chance.choice(words) for _ in range(chance.randint(1, 4))) for _ in range(chance.randint(1, 3))))
            texts.append(chance.choice(["\n", "\n\n", "\n \n"]).join(parts) + chance.choice(["", "\n", " \n\n"]))
            rows.append((conv, turn, chance.choice("ab"), texts[-1].replace("\n", chance.choice(["\n", "\r\n", "\r"]))))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_generated_quotes_equal_a_plain_parser(spark, seed):
    rows = generated(seed)
    got = run(spark, rows)
    want = by_hand(rows)
    assert len(got) == len(rows) and any(v[2] for v in want.values())
    for r in got:
        assert (r.reply_to, r.n_quotes, r.n_linked, r.thread, r.text) == want[r.conv_id, r.turn], (r.conv_id, r.turn)
    for conv in {r[0] for r in rows}:
        own = [r for r in got if r.conv_id == conv]
        assert [r.place for r in own] == list(range(len(own)))
        assert [(r.thread, r.turn) for r in own] == sorted((r.thread, r.turn) for r in own)


LONG = {
    "marks": (">" * 100_000 + "deep", 100_000, ""),
    "blank lines": ("\n" * 100_000 + "> q\n" + "\n" * 100_000 + "own", 1, "own"),
    "inner blanks": ("> q\na" + " " * 1_000_000 + "b", 1, "a" + " " * 1_000_000 + "b"),
    "separators": ("> q\nkept\x85here and here too", 1, "kept\x85here and here too"),
    "blanks between marks": (">" + " " * 200_000 + "> x\nown", 1, "own"),
}


@pytest.mark.parametrize("name", LONG)
def test_long_runs_end_no_task_and_lose_no_text(spark, name):
    text, level, rest = LONG[name]
    began = time.monotonic()
    split = quotes.lines(spark.createDataFrame([(1, 1, 0, text)], "conv long, turn long, copy long, text string"))
    assert split.selectExpr("max(level)").first()[0] == level
    assert time.monotonic() - began < 5
    got = {r.turn: r for r in run(spark, [(1, 0, "a", "q"), (1, 1, "b", text)])}
    assert got[1].text == rest and got[1].n_quotes == 1


def test_a_long_thread_is_put_in_order_by_several_tasks(spark):
    rows = [(1, 0, "a", "start")] + [(1, t, "a", f"> start\nanswer {t}") for t in range(1, 1000)] + [(1, 1500 + t, "b", "alone") for t in range(200)]
    got = run(spark, rows)
    assert [(r.place, r.turn) for r in got] == list(enumerate([*range(1000), *range(1500, 1700)]))
    assert {r.thread for r in got[:1000]} == {0}
