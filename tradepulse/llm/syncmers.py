"""Document fingerprints from closed syncmers, in DataFrame operations only.

A text of any length is one sequence of units: its words, and of a word with more than
``LONG`` characters each character. A run of ``LENGTH`` units is chosen if, of the runs of
``INNER`` units inside it, the one with the least hash is the first or the last. Whether a run
is chosen depends on nothing around it, so two texts that share a passage share the anchors
in it, wherever it stands. A sequence shorter than ``LENGTH`` units is one run, always
chosen; where no run is chosen (of five or six units), all are.

The fingerprint is a digest of all anchors with their positions; the ``KEPT`` least hashes
stand beside it as a sketch. Two texts are compared by all anchors of both: their likeness is
the share of different anchors that both have, and ``aligned`` is how many of these lie on
the diagonal that has most, so at one distance of positions. An anchor that a text repeats
lies where it is first.

Defined results: a null text counts as empty; a text without a word has no anchor and an
empty sketch; two texts without anchors are alike (1), one without and another one are not
(0); rows that share an id have the same next document, and of several rows with the next
id the text with the least hash counts; a single document is its own next one; a null id
sorts first; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.llm.common import written

#: Units of an anchor and of the runs inside it; hashes of a sketch.
LENGTH, INNER, KEPT = 5, 2, 64
#: Stands for a null id; it sorts before all others.
NO_ID = -(1 << 63)
#: Words with more characters than this are no unit; their characters are.
LONG = 16
UNIT = rf"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{{1,{LONG}}}(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _anchors(units: Column, salt: int) -> Column:
    """Array of (position, hash) of the chosen runs of an array of strings."""
    inner = LENGTH - INNER + 1

    def chosen(hashes: Column) -> Column:
        def edge(i: Column) -> Column:
            middle = [F.get(hashes, i + j) for j in range(1, inner - 1)]
            return F.least(F.get(hashes, i), F.get(hashes, i + inner - 1)) <= F.least(*middle)

        def anchor(i: Column) -> Column:
            return F.struct(i.alias("position"), F.xxhash64(*[F.get(hashes, i + j) for j in range(0, inner, INNER)], F.get(hashes, i + inner - 1)).alias("hash"))

        runs = F.sequence(F.lit(0), F.size(hashes) - inner)
        return F.transform(_let(F.filter(runs, edge), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(runs)), anchor)

    def of_units(u: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(u) - INNER), lambda i: F.xxhash64(*[F.get(u, i + j) for j in range(INNER)], F.lit(salt)))
        alone = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(u, F.lit(salt + 1)).alias("hash")))
        return F.when(F.size(u) >= LENGTH, _let(runs, chosen)).when(F.size(u) > 0, alone).otherwise(F.slice(alone, 1, 0))

    return _let(units, of_units)


def anchors_of(text: Column) -> Column:
    """Array of (position, hash) of a text; positions count units."""
    return _anchors(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), 1)


def anchors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``position`` and ``hash`` of every anchor, to match texts by position."""
    found = F.explode(anchors_of(F.coalesce(text_col, F.lit("")))).alias("_a")
    return df.select(id_col, found).select(id_col, "_a.position", "_a.hash")


def fingerprint(anchors: Column) -> Column:
    """Digest of all positions and hashes."""
    return F.lower(F.hex(F.xxhash64(anchors)))


def firsts(anchors: Column) -> Column:
    """Array of (hash, position), by hash: every different anchor where it is first."""
    ordered = F.sort_array(F.transform(anchors, lambda a: F.struct(a["hash"].alias("hash"), a["position"].alias("position"))))

    def first(found: Column) -> Column:
        return F.filter(found, lambda a, i: (i == 0) | (F.get(found, i - 1)["hash"] != a["hash"]))

    return _let(ordered, first)


def sketch(found: Column) -> Column:
    """The least hashes of ``firsts``, in order."""
    return F.transform(F.slice(found, 1, KEPT), lambda a: a["hash"])


def _longest(shifts: Column) -> Column:
    """How often the most frequent value of an array is in it."""
    none = F.struct(F.lit(None).cast("int").alias("at"), F.lit(0).alias("n"), F.lit(0).alias("most"))

    def more(seen: Column, shift: Column) -> Column:
        n = F.when(seen["at"] == shift, seen["n"] + 1).otherwise(1)
        return F.struct(shift.alias("at"), n.alias("n"), F.greatest(seen["most"], n).alias("most"))

    return F.aggregate(F.sort_array(shifts), none, more, lambda seen: seen["most"])


def match(a: Column, b: Column) -> Column:
    """``near`` and ``aligned`` of the ``firsts`` of two texts."""

    def shifts(both: Column) -> Column:
        def shift(x: Column, i: Column) -> Column:
            before = F.get(both, i - 1)
            return F.when(before["hash"] == x["hash"], x["position"] - before["position"])

        return F.filter(F.transform(both, shift), lambda d: d.isNotNull())

    def told(shared: Column) -> Column:
        union = F.size(a) + F.size(b) - F.size(shared)
        near = F.when(union == 0, F.lit(1.0)).otherwise(F.size(shared) / union)
        return F.struct(near.alias("near"), _longest(shared).alias("aligned"))

    def side(found: Column, number: int) -> Column:
        return F.transform(found, lambda x: F.struct(x["hash"].alias("hash"), F.lit(number).alias("side"), x["position"].alias("position")))

    # a hash is at most twice in it, once for each side
    both = F.sort_array(F.concat(side(a, 0), side(b, 1)))
    return _let(_let(both, shifts), told)


def printed(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ",")


def _next_ids(docs: DataFrame) -> DataFrame:
    """``before`` of every ``key``: the key that it follows.

    Keys are cut into ranges; the neighbour of a range's first key is the last one of the
    range before, so only last keys meet in one window.
    """
    keys = docs.select("key").distinct()
    ranged = written(keys.repartitionByRange("key").select("key", F.spark_partition_id().alias("part")), "ids")
    last = ranged.groupBy("part").agg(F.max("key").alias("last"))
    order = Window.orderBy("part")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = last.select("part", F.coalesce(F.lag("last").over(order), F.last("last").over(everything)).alias("earlier"))
    here = F.lag("key").over(Window.partitionBy("part").orderBy("key"))
    return ranged.withColumn("here", here).join(earlier, "part").select("key", F.coalesce("here", "earlier").alias("before"))


def with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, beside that of its edited text, and how it matches that and the next text.

    The edit replaces the last half of the characters by the first ones of the next document.
    Texts move once to where their id is, and once to their predecessor's; anchors are found
    there, as moving all of them would cost more than the texts do.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    docs = df.select(key.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = _next_ids(docs)
    # one exchange serves both sides below, so both read the same columns of it
    own = docs.repartition("key")
    follower = own.join(order, "key").select(F.col("before").alias("key"), F.col("text").alias("next"), F.xxhash64("text").alias("hash"))
    first = F.row_number().over(Window.partitionBy("key").orderBy("hash"))
    follower = follower.withColumn("first", first).filter("first = 1").drop("first", "hash")
    met = own.join(follower, "key").withColumn("n", F.length("text"))
    edited = F.expr("concat(substring(text, 1, n - n div 2), substring(next, 1, n div 2))")
    told = met.withColumn("edited", edited).select(
        "key", "n",
        F.sha2("edited", 256).alias("edited_sha256"),
        anchors_of(F.col("text")).alias("anchors"),
        anchors_of(F.col("edited")).alias("edited_anchors"),
        firsts(anchors_of(F.col("next"))).alias("next_firsts"),
    )
    told = told.withColumns({"firsts": firsts(F.col("anchors")), "edited_firsts": firsts(F.col("edited_anchors"))})
    told = told.withColumns({
        "to_edited": match(F.col("firsts"), F.col("edited_firsts")), "to_next": match(F.col("firsts"), F.col("next_firsts")),
    })
    return told.select(
        F.nullif("key", F.lit(NO_ID)).alias(id_col),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        F.col("to_edited.near").alias("near_edited"),
        F.col("to_next.near").alias("near_next"),
        F.col("to_edited.aligned").alias("aligned_edited"),
        F.col("to_next.aligned").alias("aligned_next"),
        printed(sketch(F.col("firsts"))).alias("sketch"),
        printed(sketch(F.col("edited_firsts"))).alias("edited_sketch"),
    )
