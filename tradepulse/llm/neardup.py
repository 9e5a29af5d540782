"""MinHash near-duplicates by a signature-coordinate inverted join.

A document is the set of its distinct word shingles. Equal sets form a class; only one row
of each class goes on. A class is posted under each pair of signature coordinate and value.
Coordinates are ordered by how many classes share them, rarest first: two signatures that
agree in ``MATCHES`` coordinates share one of the first ``COORDINATES - MATCHES + 1``. So
classes with fewer shared coordinates than ``MATCHES`` are skipped, and of the others only
that prefix is merged; pairs whose signatures agree often enough are confirmed on full sets.

No posting list is turned into pairs. Each list names a leader (the class with most copies),
and all lists of a leader are one group, dealt out in parts. Members are compared with their
leader, one row each. The members that it does not link meet the rest of the group in tiles of bounded size,
which yield at most one link for each row; so the work is linear in a group but for those.

Chance of missing a pair at similarity 0.8: below 1e-5, and falling steeply above it.

Defined results: a null text counts as empty; an empty set is linked with nothing and is its
own component; a row without id takes its class's component, or none; rows that share an id
are one document, so their links join; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.common import small, written
from tradepulse.llm.components import components

#: Words of a shingle, and least similarity in hundredths.
WIDTH, LEAST = 5, 80
#: Coordinates of a signature, and how many must agree.
COORDINATES, MATCHES = 32, 15
#: Members of a group that a tile holds of either kind, on average.
TILE = 256

_RANDOM = np.random.default_rng(20240229)
_FLIP = _RANDOM.integers(0, 1 << 32, (COORDINATES, 1), dtype=np.uint32)
_ODD = _RANDOM.integers(0, 1 << 31, (COORDINATES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; fewer words are one shingle."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    rolled = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        rolled = (rolled * _STEP) ^ hashes[k : len(words) - width + 1 + k]
        rolled ^= rolled >> np.uint64(32)
        rolled *= _MIX
    return np.unique(rolled ^ (rolled >> np.uint64(33)))


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    low = found.astype(np.uint32)
    for at in range(0, len(low), 4096):
        least = np.minimum(least, ((low[at : at + 4096] ^ _FLIP) * _ODD).min(axis=1))
    return least


def signed(df: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_shingles``, ``digest`` of the set (null if empty) and ``signature``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sizes, digests, values = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, width)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None)
                values.append(signature(found).view(np.int32) if len(found) else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(values, pa.list_(pa.int32()))],
                names=["id", "n_shingles", "digest", "signature"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sign, "id long, n_shingles long, digest string, signature array<int>")


def groups(classes: DataFrame) -> DataFrame:
    """``leader`` and ``id``: members of the merged posting lists, leaders not included."""
    posted = classes.select("id", "copies", F.posexplode("signature").alias("at", "value")).select(
        "id", "copies", F.expr("shiftleft(cast(at as long), 32) + (cast(value as long) & 4294967295)").alias("key")
    )
    lists = (
        posted.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("copies", (-F.col("id")).alias("low"))).alias("top"))
        .filter("n > 1")
        .select("key", "n", (-F.col("top.low")).alias("leader"))
    )
    shared = posted.select("id", "key").join(lists, "key")
    of_class = shared.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "key", "leader"))).alias("shared"))
    prefix = f"slice(shared, 1, size(shared) - {MATCHES - 1})"
    return (
        of_class.filter(F.size("shared") >= MATCHES)
        .select("id", F.explode(F.expr(f"array_distinct(transform({prefix}, x -> x.leader))")).alias("leader"))
        .filter("id <> leader")
    )


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1) >= MATCHES


def _similar(shared: np.ndarray | int, a: np.ndarray | int, b: int, least: int) -> np.ndarray | bool:
    return 100 * shared >= least * (a + b - shared)


def _with_leader(members: DataFrame, width: int, least: int) -> DataFrame:
    """``leader``, ``id`` and ``linked``: each member against its leader."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, None
        for batch in small(batches):
            leaders, ids = batch.column("leader").to_pylist(), batch.column("id").to_pylist()
            agree = [
                bool(_agree(np.array(a), np.array(b)))
                for a, b in zip(batch.column("signature").to_pylist(), batch.column("leader_signature").to_pylist(), strict=True)
            ]
            texts, leading = batch.column("text"), batch.column("leader_text")
            linked = []
            for i, leader in enumerate(leaders):
                if agree[i]:
                    if leader != known:
                        known, own = leader, shingles(leading[i].as_py(), width)
                    found = shingles(texts[i].as_py(), width)
                    shared = len(np.intersect1d(found, own, assume_unique=True))
                    linked.append(bool(_similar(shared, len(found), len(own), least)))
                else:
                    linked.append(False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaders, pa.int64()), pa.array(ids, pa.int64()), pa.array(linked, pa.bool_())], names=["leader", "id", "linked"]
            )

    # a leader stands in each part of its group
    leading = members.filter("id = leader").select(
        "leader", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.col("text").alias("leader_text"),
        F.col("signature").alias("leader_signature"),
    )
    pairs = members.filter("id <> leader").drop("parts").join(leading, ["leader", "part"])
    return pairs.select("leader", "id", "text", "signature", "leader_text", "leader_signature").mapInArrow(
        compare, "leader long, id long, linked boolean"
    )


def _tile_links(tile: pa.Table, width: int, least: int) -> pa.Table:
    """A link for each row at most: outliers against members, joined as they are found."""
    outlier = np.array(tile["outlier"].to_pylist(), bool)
    ids, signatures = tile["id"].to_pylist(), np.array(tile["signature"].to_pylist(), np.int32)
    texts = tile["text"]
    out, rest = np.flatnonzero(outlier), np.flatnonzero(~outlier)
    candidates = [rest[_agree(signatures[rest], signatures[x])] for x in out] if len(rest) else []
    a, b, parent = [], [], {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    used = sorted({int(i) for c in candidates for i in c})
    if used:
        sets = [shingles(texts[i].as_py(), width) for i in used]
        sizes = np.array([len(s) for s in sets])
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(used)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        for x, found in zip(out, candidates, strict=True):
            if not len(found) or (len(found) == 1 and ids[found[0]] == ids[x]):
                continue
            own = shingles(texts[int(x)].as_py(), width)
            first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            counts = last - first
            places = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            shared = np.bincount(owner[places], minlength=len(used))
            for y in np.flatnonzero(_similar(shared, sizes, len(own), least)):
                i, j = ids[x], ids[used[y]]
                if i != j and top(i) != top(j):
                    parent[top(i)] = top(j)
                    a.append(i)
                    b.append(j)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _among_outliers(members: DataFrame, compared: DataFrame, width: int, least: int) -> DataFrame:
    """Links (a, b) of the members that their leader does not link, within their groups."""
    sizes = compared.groupBy("leader").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("parts"),
        F.ceil(F.count_if(~F.col("linked")) / F.lit(TILE)).cast("int").alias("out_parts"),
        F.count(F.lit(1)).alias("n"),
    )
    open_groups = sizes.filter("out_parts > 0 and n > 1").drop("n")
    rows = members.drop("part", "parts").join(compared.join(open_groups, "leader"), ["leader", "id"])
    part = "cast(pmod(xxhash64(id), {}) as int)"
    shape = ["leader", "id", "signature", "text"]
    every = rows.select(
        *shape, F.lit(False).alias("outlier"), F.expr(part.format("parts")).alias("part"),
        F.explode(F.expr("sequence(0, out_parts - 1)")).alias("out_part"),
    )
    outliers = rows.filter(~F.col("linked")).select(
        *shape, F.lit(True).alias("outlier"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
        F.expr(part.format("out_parts")).alias("out_part"),
    )

    def join(tile: pa.Table) -> pa.Table:
        return _tile_links(tile, width, least)

    return every.unionByName(outliers).groupBy("leader", "part", "out_part").applyInArrow(join, "a long, b long")


def near_duplicates(
    df: DataFrame, width: int = WIDTH, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    ``least`` is in hundredths and should be 80 or more: ``MATCHES`` is chosen for that.
    """
    rows = written(signed(df, width, id_col, text_col), "signatures")
    classes = (
        rows.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.any_value("signature").alias("signature"))
        .filter("id is not null")
    )
    classes = written(classes, "classes")
    found = groups(classes)
    found = written(found.unionByName(found.select(F.col("leader").alias("id"), "leader").distinct()), "groups")
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # only large groups are in this table, so it is small and meets the members without a shuffle by leader
    large = found.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts")).filter("parts > 1")
    large = written(large, "large-groups")
    parted = found.join(large, "leader", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    parted = parted.withColumn("part", F.expr("cast(pmod(xxhash64(id, 5), parts) as int)"))
    members = parted.join(classes.select("id", "signature"), "id").join(texts, "id")
    members = written(members.select("leader", "id", "part", "parts", "signature", "text"), "members")
    compared = written(_with_leader(members, width, least), "compared")
    links = compared.filter("linked").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    joined = components(links.unionByName(_among_outliers(members, compared, width, least)))
    of_class = classes.select("digest", F.col("id").alias("node")).join(joined, "node", "left")
    placed = rows.drop("signature").join(of_class, "digest", "left")
    return placed.select(
        "id", "n_shingles", F.coalesce("component", "node", "id").alias("component_id")
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
