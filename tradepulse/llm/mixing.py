"""Mixing sources to target weights, in DataFrame operations only.

The words of each source are packed into blocks of a fixed length, in a pseudorandom order of
its documents. A source fills as many slots of the mix as its target needs. How many of them
each output shard holds is a multinomial draw given that total, so that targets are met. The
slots of a shard go on where those of the one before end; slot number j of a source takes the
block that a pseudorandom permutation of the source's block numbers maps j to, and starts over
when all blocks are used. Blocks and slots meet in a join by source and block number.

Defined results: a null text has no words; documents without words are not taken; a null
source is a source of its own, the last one; ties in the packing order go by id, then size;
repeated rows are packed each; an empty table gives no row; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.llm.common import ranges, running_start, written

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block; output shards; rounds of the permutation; how often a word is used at most.
BLOCK, SHARDS, ROUNDS, MOST = 64, 32, 16, 3
#: Documents of a source that one task puts in order; slots that one row and one task expand.
RUN, SLOTS, TASK_SLOTS = 2000, 10_000, 200_000
SEED = 11


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """One row per source: ``rank``, ``source_size``, ``target``, ``blocks``, ``slots``, ``docs``.

    Weights are 1, 2, 3, repeating, by code point. A target is level * weight, and at most
    ``most`` times the size. With sources ordered by the level at which they stop, the level
    that uses up all words is the highest of those that follow if all earlier ones stop.
    """
    of_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"), F.lit(1).cast("long").alias("one")
    )
    by_name = [F.col("source").asc_nulls_last()]
    ranked = running_start(ranges(of_source, by_name, "by-name"), [], "_part", by_name, "one", "rank").drop("_part", "one")
    weighed = ranked.withColumns({"weight": F.col("rank") % 3 + 1, "stop": F.col("source_size") * most})
    by_stop = [F.col("stops_at"), F.col("rank")]
    parted = ranges(weighed.withColumn("stops_at", F.col("stop") / F.col("weight")), by_stop, "by-stop")
    stopped = running_start(parted, [], "_part", by_stop, "stop", "stopped")
    before = running_start(stopped, [], "_part", by_stop, "weight", "weight_before")
    whole = parted.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level = written(before.withColumn("level", (F.lit(whole.size) - F.col("stopped")) / (F.lit(whole.weight) - F.col("weight_before"))), "levels")
    highest = level.agg(F.max("level")).first()[0]
    target = F.least(F.col("stop").cast("double"), F.lit(highest).cast("double") * F.col("weight"))
    return (
        level.withColumn("target", target)
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn(
            "slots",
            F.when(F.col("source_size") > 0, F.round(F.col("blocks") * F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
        )
        .select("source", "rank", "source_size", "target", "blocks", "slots", "docs")
    )


def permuted(number: Column, size: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Image of ``number`` under a permutation of 0 to ``size`` - 1 that ``key`` chooses.

    Each round mirrors the number at a random point, or not, by a random bit that it shares
    with its mirror image; so each round is its own inverse.
    """

    def step(x: Column, turn: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(turn, key, F.lit(SEED)), size) - x, size)
        swap = F.xxhash64(turn, key, F.greatest(x, mirror)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), number, step)


def shard_counts(sources: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rank``, ``shard``, ``n`` and ``start``: a multinomial draw of each source's slots over the shards.

    A source's total is given, so its counts add up to ``slots``; ``start`` is their running sum.
    """
    runs = sources.filter("slots > 0").select(
        "rank", "slots", F.explode(F.expr(f"sequence(0L, (slots - 1) div {SLOTS})")).alias("run")
    )
    slots = _spread(runs, sources).select(
        "rank", F.explode(F.expr(f"sequence(run * {SLOTS}, least(slots, (run + 1) * {SLOTS}) - 1)")).alias("slot")
    )
    shard = F.pmod(F.xxhash64("slot", "rank", F.lit(SEED + 1)), F.lit(shards)).cast("int")
    counts = slots.groupBy("rank", shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _spread(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Runs of slots over as many tasks as all slots need."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    return runs.repartition(1 + total // TASK_SLOTS, *[c for c in ("rank", "shard", "run") if c in runs.columns])


def draw(sources: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rank``, ``shard``, ``slot`` (numbered in its shard) and ``block`` of every slot of the mix."""
    counts = shard_counts(sources, shards).join(sources.select("rank", "blocks"), "rank")
    runs = counts.select("rank", "shard", "blocks", "n", "start", F.explode(F.expr(f"sequence(0L, (n - 1) div {SLOTS})")).alias("run"))
    slots = _spread(runs, sources).select(
        "rank", "shard", "blocks", "start", F.explode(F.expr(f"sequence(run * {SLOTS}, least(n, (run + 1) * {SLOTS}) - 1)")).alias("slot")
    )
    index = (F.col("start") + F.col("slot")) % F.col("blocks")
    return slots.select("rank", "shard", "slot", permuted(index, F.col("blocks"), F.col("rank")).alias("block"))


def packed(sized: DataFrame, sources: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``sized`` with ``rank``, ``source_size``, ``target`` and ``at``, its first word's place in the source.

    ``rank`` and ``at`` tell apart all rows that have words.
    """
    own = sources.select(F.col("source").alias("_source"), "rank", "source_size", "target", "docs")
    rows = sized.join(own, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    # by size too, so that rows that share an id, or have none, are dealt out
    spot = F.xxhash64(F.col(id_col), F.col("size"), F.lit(SEED + 2))
    parted = rows.withColumn("part", F.pmod(spot, F.ceil(F.col("docs") / RUN)))
    order = [F.xxhash64(F.col(id_col), F.lit(SEED + 3)), F.col(id_col), F.col("size")]
    return running_start(parted, ["rank"], "part", order, "size", "at").drop("part", "docs")


def spans(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rank``, ``block``, ``at``, ``first`` and ``words``: the part of each document in each block."""
    cut = placed.filter("size > 0").select(
        "rank", "at", "size", F.explode(F.expr(f"sequence(at div {block}, (at + size - 1) div {block})")).alias("block")
    )
    start = F.greatest(F.col("at"), F.col("block") * block)
    stop = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block)
    return cut.select("rank", "block", "at", (start - F.col("at")).alias("first"), (stop - start).alias("words"))


def mix(placed: DataFrame, sources: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """The mix itself: ``shard``, ``rank``, ``slot`` and the spans that fill the slot, word by word."""
    # Spark takes what is expanded from the small table of sources for small, too
    return spans(placed, block).join(draw(sources, shards).hint("merge"), ["rank", "block"])


def taken(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target``, ``taken`` and ``shards``, where its words go, of every row."""
    sized = written(df.select(F.col(id_col), F.col(source_col).alias("source"), word_count(text_col).alias("size")), "sizes")
    sources = written(targets(sized), "sources")
    placed = written(packed(sized, sources, id_col), "packed")
    words = mix(placed, sources).groupBy("rank", "at").agg(
        F.sum("words").alias("_taken"), F.array_sort(F.collect_set("shard")).alias("shards")
    )
    joined = placed.join(words.withColumn("size_", F.lit(True)), ["rank", "at"], "left")
    used = F.col("size") > 0  # rows without words share their place with the next one
    own = F.when(used, F.coalesce("_taken", F.lit(0))).otherwise(0).cast("long")
    where = F.coalesce(F.when(used, F.col("shards")), F.array().cast("array<int>")).alias("shards")
    return joined.select(id_col, "size", "source_size", "target", own.alias("taken"), where)


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``df`` as the mix has it: each document as often as its words are used, with those words.

    A document that a pass uses whole keeps its text; of others the words used remain, with
    single spaces. Columns stay as they are. What is counted and ordered carries two hashes
    of a row and not its text, which meets the words it is asked for once, at the end. Equal
    rows have equal hashes and are as good as one another.
    """
    columns = df.columns
    keys = ["_key", "_check"]
    keyed = df.select(*columns, *[F.xxhash64(*columns, F.lit(SEED + i)).alias(k) for i, k in enumerate(keys, 4)])
    sized = keyed.select(*keys, F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    sized = written(sized, "sizes")
    sources = written(targets(sized.select("source", "size")), "sources")
    placed = written(packed(sized, sources, "_id"), "packed")
    uses = mix(placed.select("rank", "at", "size"), sources).groupBy("rank", "at", "first", "words").agg(F.count(F.lit(1)).alias("times"))
    parts = uses.groupBy("rank", "at").agg(F.array_sort(F.collect_list(F.struct("first", "words", "times"))).alias("parts"))
    of_row = placed.filter("size > 0").select("rank", "at", "size", *keys).join(parts, ["rank", "at"])
    passes = of_row.select(*keys, "size", "parts", F.explode(F.expr("sequence(1L, array_max(transform(parts, p -> p.times)))")).alias("turn"))
    cut = passes.select(*keys, "size", F.expr("filter(parts, p -> p.times >= turn)").alias("own"))

    repeated = written(sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys), "repeated")
    once = keyed.join(repeated, keys, "left_anti").unionByName(keyed.join(repeated, keys, "left_semi").dropDuplicates(keys))
    named = once.select(*keys, *[F.col(c).alias(f"_row_{i}") for i, c in enumerate(columns)])
    text = F.col(f"_row_{columns.index(text_col)}")
    whole = F.expr("aggregate(own, 0L, (n, p) -> n + p.words)") == F.col("size")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def taken_of(all_words: Column) -> Column:
        return F.flatten(F.transform("own", lambda p: F.slice(all_words, (p["first"] + 1).cast("int"), p["words"].cast("int"))))

    # the words are found once for all parts
    pieces = F.array_join(F.flatten(F.transform(F.array(words), taken_of)), " ")
    own_text = F.when(whole, text).otherwise(pieces)
    return named.join(cut, keys).select(*[(own_text if c == text_col else F.col(f"_row_{i}")).alias(c) for i, c in enumerate(columns)])
