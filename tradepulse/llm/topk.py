"""Exact top-k inner products by a pivot-distance index.

Every vector gets one more component, so that all have the same length; then the largest
inner products are the smallest distances (a query's extra component is 0). Vectors are
keyed by their nearest pivot and the distance to it, sorted, and packed into annuli of a
bounded number of rows. By the triangle inequality a vector in an annulus [low, high] is at
least max(low - d, d - high) away from a query at distance d from the pivot. Queries are
packed the same way, so one matrix product scores a block of queries against an annulus.

Which annuli a block of queries has to visit is decided on rows without vectors: the range
of an annulus and the ranges that the block's radii reach around each pivot. A query's radius
comes from the pivots' sample at first; the nearest annuli are visited, what they hold
shrinks the radii, and only annuli within these are fetched then.

Defined results: null vectors and vectors with a null or non-finite component take no part;
shorter vectors count as if filled up with zeros; rows with the query's own id are no
candidates; query rows that share an id have one result, the best of all their scores;
candidates that share an id are scored each; equal scores go to the smaller id; fewer
candidates than k are all returned; an empty table gives no row; extra columns are not
looked at.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradepulse.llm.common import written

#: Rows of an annulus; queries of a block; annuli of a pivot that the number of pivots aims at.
ROWS, QUERIES, ANNULI = 1024, 256, 4
#: Fewest and most pivots (they travel with each task); vectors of the sample for each of them, and at least.
PIVOTS, MOST_PIVOTS, SAMPLED, SAMPLE = 48, 1024, 8, 2048
#: Annuli that a block of queries visits first; pairs of blocks that a task scores; blocks of queries that meet in one copy of an annulus.
FIRST, TASK_PAIRS, MEETING = 4, 64, 256
#: Queries whose best candidates a task holds before it passes them on.
HELD = 50_000

log = logging.getLogger(__name__)


def whole_numbers(column: str = "embedding", scale: int = 256) -> str:
    """SQL for floor(scale * x) of every component; null for vectors that take no part."""
    bad = f"exists({column}, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    return f"case when not {bad} then transform({column}, x -> floor({scale} * cast(x as double))) end"


@dataclass
class Pivots:
    """Pivots with the extra component, the sample they come from, and the squared length."""

    points: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray
    square: float
    width: int

    def extended(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.square - (vectors * vectors).sum(axis=1), 0.0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def distances(self, points: np.ndarray) -> np.ndarray:
        squares = (points * points).sum(axis=1)[:, None] + (self.points * self.points).sum(axis=1) - 2 * points @ self.points.T
        return np.sqrt(np.maximum(squares, 0.0))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    lengths = np.diff(vectors.offsets.to_numpy())
    if len(vectors) and (lengths == width).all():
        return vectors.flatten().to_numpy().reshape(-1, width).astype(np.float64)
    for i, v in enumerate(vectors.to_pylist()):
        out[i, : len(v)] = v
    return out


def choose_pivots(vectors: DataFrame) -> Pivots | None:
    """Centres of a bounded sample: far apart at first, then moved to the means of their own.

    There are as many as give each some annuli, within the bounds of ``PIVOTS`` and ``MOST_PIVOTS``.
    """
    shape = vectors.agg(
        F.max(F.size("v")).alias("width"), F.max(F.expr("aggregate(v, 0D, (s, x) -> s + double(x) * x)")).alias("square"), F.count(F.lit(1)).alias("n")
    ).first()
    if not shape.n:
        return None
    pivots = min(max(shape.n // (ROWS * ANNULI), PIVOTS), MOST_PIVOTS)
    sample, width = max(SAMPLE, SAMPLED * pivots), max(shape.width, 1)
    share = min(1.0, 4 * sample / shape.n)
    picked = (
        vectors.withColumn("h", F.xxhash64("v", F.lit(5)))
        .filter(F.pmod("h", F.lit(1 << 20)) <= int(share * (1 << 20)))
        .groupBy("h").agg(F.min(F.struct("id", "v")).alias("r"))
        .orderBy("h").limit(sample).select("r.id", "r.v").toArrow().combine_chunks()
    )
    ids = picked["id"].to_numpy()
    rows = _matrix(picked["v"].combine_chunks() if picked["v"].num_chunks != 1 else picked["v"].chunk(0), width)
    found = Pivots(np.zeros((0, width + 1)), rows, ids, float(shape.square), width)
    points = found.extended(rows)
    if not len(points):
        found.points = np.zeros((1, width + 1))
        return found
    centres, near = [points[0]], np.full(len(points), np.inf)
    for _ in range(min(pivots, len(points)) - 1):
        near = np.minimum(near, ((points - centres[-1]) ** 2).sum(axis=1))
        centres.append(points[int(near.argmax())])
    found.points = np.array(centres)
    for _ in range(5):
        own = found.distances(points).argmin(axis=1)
        found.points = np.array([points[own == p].mean(axis=0) if (own == p).any() else found.points[p] for p in range(len(centres))])
    return found


def keyed(vectors: DataFrame, pivots: Pivots, queries: bool = False) -> DataFrame:
    """``id``, ``v``, ``pivot`` (the nearest) and ``distance``; queries have no extra component."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v"), pivots.width)
            away = pivots.distances(np.hstack([rows, np.zeros((len(rows), 1))]) if queries else pivots.extended(rows))
            nearest = away.argmin(axis=1) if len(rows) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(nearest, pa.int64()), pa.array(away[np.arange(len(rows)), nearest], pa.float64())],
                names=["id", "v", "pivot", "distance"],
            )

    return vectors.select("id", "v").mapInArrow(key, "id long, v array<long>, pivot long, distance double")


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers in the fewest bytes each that hold them all."""
    least, most = int(matrix.min(initial=0)), int(matrix.max(initial=0))
    fit = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    return matrix.astype(fit)


def _wide(ids: bytes, matrix: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block."""
    own = np.frombuffer(ids, "<i8")
    size = len(matrix) // max(len(own) * width, 1) or 8
    return own, np.frombuffer(matrix, f"<i{size}").reshape(len(own), width).astype(np.int64)


BLOCK_DDL = "pivot long, low double, high double, ids binary, matrix binary"


def packed(rows: DataFrame, width: int, most: int, by_pivot: bool = True) -> DataFrame:
    """Blocks of at most ``most`` rows that follow one another by pivot and distance.

    Equal keys are parted by id, so copies of one vector fill many blocks, in many tasks.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(part: pa.RecordBatch) -> list:
            away = part.column("distance").to_numpy()
            matrix = _narrow(_matrix(part.column("v"), width).astype(np.int64))
            return [part.column("pivot")[0].as_py(), away.min(), away.max(), part.column("id").to_numpy().astype("<i8").tobytes(), matrix.tobytes()]

        for batch in batches:
            pivot = batch.column("pivot").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(pivot)) + 1), len(pivot)] if by_pivot else [0, len(pivot)]
            out = [
                block(batch.slice(at, min(most, end - at)))
                for start, end in zip(edges, edges[1:], strict=False)
                for at in range(start, end, most)
            ]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            types = (pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["pivot", "low", "high", "ids", "matrix"])

    ordered = rows.repartitionByRange("pivot", "distance", "id").sortWithinPartitions("pivot", "distance", "id")
    return ordered.mapInArrow(pack, BLOCK_DDL)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can leave their whole numbers."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if largest < 2**53 else a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def bounded(asked: DataFrame, pivots: Pivots, k: int) -> DataFrame:
    """``asked`` with ``bound``: scores that the ``k`` best of each query reach, by the sample alone."""
    sample, width = pivots.sample.astype(np.int64), pivots.width

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for ids, matrix in zip(batch.column("ids").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
                own, rows = _wide(ids, matrix, width)
                scores = _product(rows, sample).astype(np.float64)
                scores[own[:, None] == pivots.sample_ids] = -np.inf
                least = np.sort(scores, axis=1)[:, -k] if len(sample) >= k else np.full(len(own), -np.inf)
                bounds.append(least.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("asked"), batch.column("ids"), batch.column("matrix"), pa.array(bounds, pa.binary())],
                names=["asked", "ids", "matrix", "bound"],
            )

    return asked.select("asked", "ids", "matrix").mapInArrow(bound, "asked long, ids binary, matrix binary, bound binary")


def raised(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``asked`` with the bounds that ``found`` (``asked``, ``query_id``, ``vec_id``, ``score``) gives."""
    place = F.row_number().over(Window.partitionBy("asked", "query_id").orderBy(F.desc("score"), "vec_id"))
    kth = found.withColumn("rank", place).filter(F.col("rank") == k)
    # a block's queries are no more than it has rows
    known = kth.groupBy("asked").agg(F.collect_list(F.struct("query_id", "score")).alias("known"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for row in batch.select(["ids", "bound", "known"]).to_pylist():
                least = np.frombuffer(row["bound"], "<f8").copy()
                reached = {x["query_id"]: x["score"] for x in row["known"] or ()}
                for i, q in enumerate(np.frombuffer(row["ids"], "<i8").tolist()):
                    least[i] = max(least[i], reached.get(q, -np.inf))
                bounds.append(least.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("asked"), batch.column("ids"), batch.column("matrix"), pa.array(bounds, pa.binary())],
                names=["asked", "ids", "matrix", "bound"],
            )

    both = asked.join(known, "asked", "left").select("asked", "ids", "matrix", "bound", "known")
    return both.mapInArrow(bound, "asked long, ids binary, matrix binary, bound binary")


def visits(asked: DataFrame, rings: DataFrame, pivots: Pivots) -> DataFrame:
    """``asked``, ``block`` and ``gap``: the annuli that blocks of queries have to visit, without their vectors."""
    width, square = pivots.width, pivots.square

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, rows = _wide(row["ids"], row["matrix"], width)
                norms = (rows.astype(np.float64) ** 2).sum(axis=1)
                slack = 1e-6 * (norms + square) + 1
                radius = np.sqrt(np.maximum(norms + square - 2 * np.frombuffer(row["bound"], "<f8") + slack, 0))
                away = pivots.distances(np.hstack([rows, np.zeros((len(own), 1))]))
                n = away.shape[1]
                spans = [(away - radius[:, None]).min(axis=0), (away + radius[:, None]).max(axis=0), away.min(axis=0), away.max(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["asked"]), pa.int64()), pa.array(np.arange(n), pa.int64()), *[pa.array(x, pa.float64()) for x in spans]],
                    names=["asked", "pivot", "from", "to", "nearest", "farthest"],
                )

    ranges = asked.mapInArrow(reach, "asked long, pivot long, from double, to double, nearest double, farthest double")
    gap = F.greatest(F.col("low") - F.col("farthest"), F.col("nearest") - F.col("high"), F.lit(0.0))
    return ranges.join(rings, "pivot").filter("high >= from and low <= to").select("asked", "block", gap.alias("gap"))


def scored(pairs: DataFrame, asked: DataFrame, index: DataFrame, pivots: Pivots, k: int, n_pairs: int, copies: int) -> DataFrame:
    """``asked``, ``query_id``, ``vec_id`` and ``score``: the best that the pairs of blocks hold.

    A block of queries travels to each annulus it visits; an annulus that many of them visit
    has ``copies``, so that no task has to take all its visitors.
    """
    width, square = pivots.width, pivots.square

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def passed_on() -> pa.RecordBatch:
            sizes = [len(s) for s, _ in held.values()]
            keys = np.array(list(held), np.int64).reshape(-1, 2)
            columns = [np.repeat(keys[:, 0], sizes), np.repeat(keys[:, 1], sizes)]
            for i in (1, 0):
                columns.append(np.concatenate([v[i] for v in held.values()]) if held else np.zeros(0, np.int64))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["asked", "query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                query_ids, rows = _wide(row["query_ids"], row["queries"], width)
                bound = np.frombuffer(row["bound"], "<f8").copy()
                for i, q in enumerate(query_ids.tolist()):
                    before = held.get((row["asked"], q))
                    if before and len(before[0]) == k:
                        bound[i] = max(bound[i], before[0][-1])
                norms = (rows.astype(np.float64) ** 2).sum(axis=1)
                gaps = rows - pivots.points[row["pivot"], :-1]
                away = np.sqrt((gaps * gaps).sum(axis=1) + pivots.points[row["pivot"], -1] ** 2)
                least = np.maximum(np.maximum(row["low"] - away, away - row["high"]), 0)
                most = (norms + square - least**2) / 2 + 1e-6 * (norms + square) + 1
                open_queries = np.flatnonzero(most >= bound)
                if not len(open_queries):
                    continue
                ids, matrix = _wide(row["ids"], row["matrix"], width)
                scores = _product(rows[open_queries], matrix)
                for i, own in zip(open_queries.tolist(), scores, strict=True):
                    q = int(query_ids[i])
                    good = (own >= bound[i]) & (ids != q)
                    if good.any():
                        before = held.get((row["asked"], q), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                        held[row["asked"], q] = _best(np.concatenate([before[0], own[good]]), np.concatenate([before[1], ids[good]]), k)
                if len(held) > HELD:
                    yield passed_on()
        yield passed_on()

    queries = asked.select("asked", F.col("ids").alias("query_ids"), F.col("matrix").alias("queries"), "bound")
    sent = pairs.select("asked", "block").join(queries, "asked").withColumn("copy", F.pmod(F.hash("asked"), F.lit(copies)))
    annuli = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    met = sent.repartition(1 + n_pairs // TASK_PAIRS, "block", "copy").join(annuli, ["block", "copy"])
    return met.select("asked", "query_ids", "queries", "bound", "pivot", "low", "high", "ids", "matrix").mapInArrow(
        score, "asked long, query_id long, vec_id long, score long"
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` best.

    Both frames have ``id`` and ``v`` (whole numbers); rows without ``v`` take no part. The
    log says how many pairs of blocks were scored.
    """
    vectors, queries = vectors.filter("v is not null and id is not null"), queries.filter("v is not null and id is not null")
    vectors = written(vectors.select("id", "v"), "vectors")
    pivots = choose_pivots(vectors)
    spark = vectors.sparkSession
    if pivots is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = pivots.width
    number = F.monotonically_increasing_id()
    index = written(packed(keyed(vectors, pivots), width, ROWS).withColumn("block", number), "annuli")
    own = keyed(queries.select("id", F.expr(f"slice(v, 1, {width})").alias("v")), pivots, True)
    asked = written(packed(own, width, QUERIES, False).withColumn("asked", number), "queries")
    rings = index.select("block", "pivot", "low", "high")
    n_asked, n_rings = asked.count(), index.count()
    copies = 1 + n_asked // MEETING

    asked = written(bounded(asked, pivots, k), "bounded")
    nearest = F.row_number().over(Window.partitionBy("asked").orderBy("gap", "block"))
    first = written(visits(asked, rings, pivots).withColumn("rank", nearest).filter(F.col("rank") <= FIRST), "first")
    found = written(scored(first, asked, index, pivots, k, first.count(), copies), "found")
    asked = written(raised(asked, found, k), "raised")
    rest = written(visits(asked, rings, pivots).join(first.select("asked", "block"), ["asked", "block"], "left_anti"), "rest")
    n_first, n_rest = first.count(), rest.count()
    log.info("%d pairs of blocks scored of %d", n_first + n_rest, n_asked * n_rings)
    best = found.unionByName(scored(rest, asked, index, pivots, k, n_rest, copies))
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", ranked).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
