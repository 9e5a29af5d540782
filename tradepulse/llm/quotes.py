"""Chat formatting by quotation linking, in DataFrame operations only.

A line's quote level is the number of ``>`` in front of it. Neighbouring lines of one level
form a passage; blank ones part passages. A passage is normalised (letter case and white
space) and hashed. A quoted passage is joined to the first message of its conversation that
has it as a passage of its own; a message replies to the latest message it quotes. Messages
that reply to one another are one thread, and a conversation is put in the order of its
threads' first turns, then of turns, so that each reply follows what it answers.

Defined results: a null text stays null and quotes nothing; a text that is all quotes becomes
empty; a passage that occurs nowhere earlier is dropped like the other quotes, but links to
nothing; copies of a passage link to its first message; a null conversation is one of its
own; a null turn sorts first and links to nothing; repeated rows each get a place; lines end
at ``\\n``, ``\\r`` or both, other separators belong to their line; texts, lines and runs of
marks or blanks may be of any length; an empty table gives no row; extra columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.llm.common import running_start, written
from tradepulse.llm.components import components

# Fixed value: what quoted lines begin with, marks and blanks; up to three blanks may stand before a mark.
MARKS, BLANKS = r"^[ \t>]*", " " * 4
WHITE = " \t\n\x0b\f\r"
#: Turns, or threads, that one task puts in order.
RUN = 64


def lines(messages: DataFrame) -> DataFrame:
    """One row per line: ``conv``, ``turn``, ``copy``, ``number``, ``level``, ``body`` and ``blank``.

    Marks end at the first four blanks in a row. Behind them one blank more is not the line's own.
    """
    split = messages.select("conv", "turn", "copy", F.posexplode(F.split("text", r"\r\n|\n|\r")).alias("number", "line"))
    before = F.translate(F.regexp_extract("line", MARKS, 0), "\t", " ")
    marks = F.rtrim(F.substring_index(before, BLANKS, 1))
    marked = split.withColumn("marks", marks).withColumn("rest", F.expr("substring(line, length(marks) + 1)"))
    level = F.length("marks") - F.length(F.translate("marks", ">", ""))
    body = F.when((F.col("marks") != "") & F.substring("rest", 1, 1).isin(" ", "\t"), F.expr("substring(rest, 2)")).otherwise(F.col("rest"))
    return marked.select("conv", "turn", "copy", "number", level.alias("level"), body.alias("body"), (~body.rlike(r"\S")).alias("blank"))


def passages(split: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``copy``, ``level`` and ``hash`` of every passage."""
    of_message = Window.partitionBy("conv", "turn", "copy").orderBy("number")
    starts = F.coalesce(F.col("blank") | F.lag("blank").over(of_message) | (F.lag("level").over(of_message) != F.col("level")), F.lit(True))
    numbered = split.withColumn("passage", F.sum(starts.cast("int")).over(of_message.rowsBetween(Window.unboundedPreceding, 0)))
    joined = (
        numbered.filter(~F.col("blank"))
        .groupBy("conv", "turn", "copy", "passage", "level")
        .agg(F.array_sort(F.collect_list(F.struct("number", "body"))).alias("parts"))
    )
    text = F.array_join(F.transform("parts", lambda p: p["body"]), " ")
    normal = F.trim(F.regexp_replace(F.lower(text), r"[\s\p{Z}]+", " "))
    return joined.select("conv", "turn", "copy", "level", F.sha2(normal, 256).alias("hash"))


def linked(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every message without its quotes, with ``reply_to``, ``thread`` and ``place``.

    Also ``n_quotes`` (quoted passages) and ``n_linked`` (those found in an earlier message).
    """
    rows = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    ).withColumn("copy", F.xxhash64("role", "text"))
    # only messages that quote are taken apart, and of the others those in a conversation with a quote
    quoting = rows.filter(F.col("text").rlike(r"(?m)^[ \t]{0,3}>"))
    conversations = quoting.select(F.col("conv").alias("_conv")).distinct()
    candidates = rows.join(conversations, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi").select("conv", "turn", "copy", "text").distinct()
    split = written(lines(candidates), "lines")
    found = written(passages(split), "passages")

    own = found.filter("level = 0 and turn is not null").groupBy(F.col("conv").alias("_conv"), "hash").agg(F.min("turn").alias("first"))
    quoted = found.filter("level > 0").select("conv", "turn", "copy", "hash")
    met = quoted.join(own, [F.col("conv").eqNullSafe(F.col("_conv")), quoted["hash"] == own["hash"]], "left")
    earlier = F.when(F.col("first") < F.col("turn"), F.col("first"))
    links = written(
        met.groupBy("conv", "turn", "copy").agg(
            F.max(earlier).alias("reply_to"), F.count(F.lit(1)).alias("n_quotes"), F.count(earlier).alias("n_linked")
        ),
        "replies",
    )
    node = lambda column: F.struct("conv", F.col(column).alias("turn"))
    threads = components(links.filter("reply_to is not null").select(node("turn").alias("a"), node("reply_to").alias("b")))
    threads = threads.select(F.col("node.conv").alias("_conv"), F.col("node.turn").alias("_turn"), F.col("component.turn").alias("thread"))

    kept = (
        split.filter("level = 0").groupBy("conv", "turn", "copy")
        .agg(F.array_sort(F.collect_list(F.struct("number", "body", "blank"))).alias("parts"))
        .withColumn("first", F.array_position(F.transform("parts", lambda p: p["blank"]), False).cast("int"))
        .select("conv", "turn", "copy", F.when(F.col("first") > 0, F.slice("parts", F.col("first"), F.size("parts"))).alias("parts"))
        .select("conv", "turn", "copy", F.rtrim(F.array_join(F.transform("parts", lambda p: p["body"]), "\n"), F.lit(WHITE)).alias("rest"))
    )
    keys = ["conv", "turn", "copy"]
    told = links.join(kept.select(*[F.col(k).alias(f"_{k}") for k in keys], "rest"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])
    told = told.select(*[F.col(k).alias(f"_{k}") for k in keys], "reply_to", "n_quotes", "n_linked", F.coalesce("rest", F.lit("")).alias("rest"))
    full = rows.join(told, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])
    full = full.join(threads, [F.col("conv").eqNullSafe(F.col("_conv")), F.col("turn").eqNullSafe(F.col("_turn"))], "left").drop("_conv", "_turn")
    full = full.select(
        "conv", "turn", "role", "copy", "reply_to",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.when(F.col("n_quotes").isNotNull(), F.col("rest")).otherwise(F.col("text")).alias("text"),
    ).withColumns({"_run": F.floor(F.col("turn") / RUN), "_one": F.lit(1).cast("long")})
    # a place is what stands in earlier threads and what is earlier in its own
    sizes = full.groupBy(F.col("conv").alias("_conv"), F.col("thread").alias("_thread")).agg(F.count(F.lit(1)).alias("n"))
    ahead = running_start(sizes.withColumn("_run", F.floor(F.col("_thread") / RUN)), ["_conv"], "_run", ["_thread"], "n", "ahead").drop("_run", "n")
    within = running_start(full, ["conv", "thread"], "_run", ["turn", "role", "copy"], "_one", "within")
    of_thread = [F.col("conv").eqNullSafe(F.col("_conv")), F.col("thread").eqNullSafe(F.col("_thread"))]
    placed = within.join(ahead, of_thread).withColumn("place", F.col("ahead") + F.col("within"))
    return placed.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "place", "thread", "reply_to", "n_quotes", "n_linked",
        F.col("text").alias(text_col),
    )
