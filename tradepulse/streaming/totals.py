"""Running totals by day and key, brought up to date partition by partition.

A step's changes are merged into the partitions they touch: each is read in its newest
version and written in a new one, by dynamic partition overwrite. Nothing else is read, so a
step costs what it touches however long the job has run. A version is named by its step:
written twice it is replaced, without a ledger row it is not seen, and once its step is
committed the versions before it are dropped.

One table holds trade totals, daily metrics and customer sets, told apart by ``kind``, so
that a step merges all of them at once. Customers of a partition are counted when it is
written; counts of the others stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.functions import expressions as E
from tradepulse.operators import customers as C
from tradepulse.operators import metrics as M
from tradepulse.streaming.tables import StepTables

TRADE, ACTIVITY, CUSTOMER, COUNT = "trade", "activity", "customer", "customers"
PARTITION = ("kind", "business_date", "part")
KEYS = {"branch": "STRING", "channel": "STRING", "metric": "STRING", "word": "BIGINT"}
MEASURES = {**M.TRADE_MEASURES, **M.ACTIVITY_MEASURES}
DDL = ", ".join(f"{name} {kind}" for name, kind in {**KEYS, **MEASURES, "mask": "BIGINT"}.items())
DDL += ", kind STRING, business_date INT, part INT, step BIGINT"
#: Words of a customer set that stay together in one partition.
WORDS_TOGETHER = 4096
#: How a folder names a day that is null.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

Part = tuple[str, int | None, int]


_OWN = {**KEYS, **MEASURES, "mask": "BIGINT"}


def changes(kind: str, rows: DataFrame) -> DataFrame:
    """Rows of one kind in the shape of the table; what they lack is null."""
    have = set(rows.columns)
    own = [f"CAST({c if c in have else 'NULL'} AS {t}) AS {c}" for c, t in _OWN.items()]
    return rows.selectExpr(f"'{kind}' AS kind", "business_date", *own)


def trade_changes(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Narrow rows of orders or fills, each amount times the rate of its currency.

    A batch's rows meet the rates without a shuffle, and one aggregation adds up all kinds.
    """
    priced = rows.join(rates.select(F.col("currency").alias("_currency"), "rate"), "_currency", "left")
    amounts = {m: E.converted(m) for m in M.CONVERTED_MEASURES if m in rows.columns}
    return changes(TRADE, priced.withColumns(amounts))


def customer_changes(people: DataFrame, side: str) -> DataFrame:
    """Customers of one side as words of their sets, still to be merged."""
    return changes(CUSTOMER, C.word_rows(people).withColumn("metric", F.lit(side)))


def _added(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    sums = [F.sum(m).cast(t).alias(m) for m, t in MEASURES.items()]
    return rows.groupBy(*by, *KEYS).agg(*sums, F.bit_or("mask").alias("mask"))


class Totals:
    """The table of running totals under a job's root; ``parts`` partitions a day and kind."""

    def __init__(self, tables: StepTables, parts: int = 8) -> None:
        self.tables, self.parts = tables, parts
        self.root = tables.path("totals")
        self._checked = False

    def _check_parts(self) -> None:
        """A key's partition follows from ``parts``, so a table keeps the number it began with."""
        if not self._checked:
            found = [path.rsplit("/", 1)[1] for path in self.tables.glob(f"{self.root}/_parts/*")]
            if found and found != [str(self.parts)]:
                raise ValueError(f"{self.root} has {found[0]} parts a day, not {self.parts}")
            self.tables.make(f"{self.root}/_parts/{self.parts}")
            self._checked = True

    def add(
        self, parts: Iterable[DataFrame], step: int, hold: Callable[[DataFrame], DataFrame], replace: bool = False
    ) -> list[Part]:
        """Merge changes into the partitions they touch; names these.

        Changes are added to what is there or, with ``replace``, take its place key by key.
        """
        rows = None
        for own in parts:
            rows = own if rows is None else rows.unionByName(own)
        if rows is None:
            return []
        self._check_parts()
        key = F.hash("branch", "channel", "metric", F.shiftright("word", WORDS_TOGETHER.bit_length() - 1))
        delta = hold(_added(rows.withColumn("part", F.pmod(key, F.lit(self.parts)).cast("int")), PARTITION))
        touched = [tuple(r) for r in delta.select(*PARTITION).distinct().collect()]
        if touched:
            self._merge(delta, touched, step, replace)
        return touched

    def _merge(self, delta: DataFrame, touched: list[Part], step: int, replace: bool) -> None:
        rows = delta.withColumn("newer", F.lit(True))
        before = [paths[-1] for paths in self.versions(touched, upto=step - 1).values()]
        if before:
            rows = rows.unionByName(self._load(before).select(*delta.columns).withColumn("newer", F.lit(False)))
        own = rows.repartition(*PARTITION)
        if replace:
            newest = F.max_by(F.struct(*MEASURES, "mask"), "newer").alias("row")
            merged = own.groupBy(*PARTITION, *KEYS).agg(newest).select(*PARTITION, *KEYS, "row.*")
        else:
            merged = _added(own, PARTITION)
        sets = merged.where(F.col("kind") == CUSTOMER)
        counted = C.word_counts(sets, [*PARTITION[1:], "branch", "channel", "metric"], "n").withColumn("kind", F.lit(COUNT))
        out = merged.unionByName(counted, allowMissingColumns=True).withColumn("step", F.lit(step).cast("bigint"))
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*PARTITION, "step").parquet(self.root)

    def _load(self, paths: list[str]) -> DataFrame:
        return self.tables.spark.read.schema(DDL).option("basePath", self.root).parquet(*paths)

    def versions(
        self, touched: Iterable[Part] | None = None, upto: int | None = None, kind: str | None = None,
        days: Iterable[int | None] | None = None,
    ) -> dict[Part, list[str]]:
        """Folders of the versions of partitions, oldest first; of all partitions, kinds and days if left out.

        Only folders of the days asked for are listed.
        """
        wanted = None if touched is None else set(touched)
        if wanted is not None:
            days = {day for _, day, _ in wanted}
        names = "*" if days is None else "{" + ",".join(sorted(NO_DAY if d is None else str(d) for d in set(days))) + "}"
        found: dict[Part, list[tuple[int, str]]] = {}
        for path in self.tables.glob(f"{self.root}/kind={kind or '*'}/business_date={names}/part=*/step=*"):
            own, day, part, step = (piece.split("=", 1)[1] for piece in path.rsplit("/", 4)[1:])
            name = own, None if day == NO_DAY else int(day), int(part)
            if (wanted is None or name in wanted) and (upto is None or int(step) <= upto):
                found.setdefault(name, []).append((int(step), path))
        return {name: [path for _, path in sorted(paths)] for name, paths in found.items()}

    def rows(self, kind: str, days: Iterable[int | None] | None = None) -> DataFrame:
        """Committed rows of a kind, of the days named if any are: each partition in its newest version."""
        last = self.tables.last_step()
        paths = [] if last is None else [p[-1] for p in self.versions(upto=last, kind=kind, days=days).values()]
        if not paths:
            return self.tables.spark.createDataFrame([], DDL)
        return self._load(paths)

    def drop_older(self, touched: Iterable[Part], step: int) -> None:
        """Drop versions that a committed step has replaced."""
        own = set(touched)
        own |= {(COUNT, day, part) for kind, day, part in own if kind == CUSTOMER}
        for paths in self.versions(own, upto=step).values():
            for path in paths[:-1]:
                self.tables.delete(path)

    def clear_after(self, step: int | None) -> None:
        """Drop versions of steps without a ledger row."""
        for path in self.tables.glob(f"{self.root}/kind=*/business_date=*/part=*/step=*"):
            if step is None or int(path.rsplit("=", 1)[1]) > step:
                self.tables.delete(path)
