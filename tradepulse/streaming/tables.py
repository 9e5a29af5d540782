"""Result and state tables of the streaming job: plain parquet, one folder per step.

A step is one micro-batch (even numbers) or the drain after it (odd numbers).
Steps are numbered on from the last committed one, whichever run wrote it: a run is
one checkpoint, and a micro-batch is known by its run and number. Everything a step
writes lies in its own folder in overwrite mode, so a replayed step rewrites the same
files. The ledger row is written last; readers see only steps up to the newest ledger
row, and what a failed step left beyond it is cleared before the next one.
"""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Callable, Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.session import SHUFFLES_END, settings

LEDGER_ROW = (
    "topic STRING, partition INT, min_offset BIGINT, max_offset BIGINT, n BIGINT, "
    "run STRING, batch BIGINT, day INT"
)
LEDGER_DDL = f"{LEDGER_ROW}, committed_at TIMESTAMP"


@contextlib.contextmanager
def held() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that persists frames until the block ends, however it ends."""
    frames: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        frames.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return frames[-1]

    try:
        yield hold
    finally:
        for df in frames:
            df.unpersist()


class Kept:
    """Holds the frames of a large step in files under ``folder``.

    Files take a fraction of the room of what is held in memory and spilled from there. They
    are written at once and are read without what made them, so its shuffle files can go.
    """

    def __init__(self, tables: StepTables, folder: str) -> None:
        self.tables, self.folder = tables, folder
        self._kept: list[tuple[DataFrame, str]] = []
        self._numbers = itertools.count()

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{next(self._numbers)}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        self._kept.append((df.sparkSession.read.schema(df.schema).parquet(path), path))
        return self._kept[-1][0]

    def spent(self, *frames: DataFrame | None) -> None:
        """Nothing reads these any more: the files of those that are held here go."""
        for kept, path in [pair for pair in self._kept if any(pair[0] is df for df in frames)]:
            self.tables.delete(path)
            self._kept = [pair for pair in self._kept if pair[0] is not kept]


def step_after(last: int | None) -> int:
    """The step of the next micro-batch."""
    return 0 if last is None else 2 * (last // 2 + 1)


class StepTables:
    """Step-partitioned tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hadoop_path, hadoop_path.getFileSystem(conf)

    def path(self, table: str, step: int | None = None) -> str:
        base = f"{self.root}/{table}"
        return base if step is None else f"{base}/step={step}"

    def size(self, path: str) -> int:
        """Bytes of the files of a folder; none if it is missing."""
        found, fs = self._fs(path)
        return fs.getContentSummary(found).getLength() if fs.exists(found) else 0

    @contextlib.contextmanager
    def kept(self, step: int, *sessions: SparkSession) -> Iterator[Kept]:
        """A :class:`Kept` until the block ends, however it ends; statements of ``sessions`` leave no shuffle files."""
        folder = self.path("kept", step)
        with contextlib.ExitStack() as stack:
            for spark in (self.spark, *sessions):
                stack.enter_context(settings(spark, SHUFFLES_END))
            stack.callback(self.delete, folder)
            yield Kept(self, folder)

    def exists(self, table: str, step: int | None = None) -> bool:
        path, fs = self._fs(self.path(table, step))
        return fs.exists(path)

    def glob(self, pattern: str) -> list[str]:
        """Folders and files that match a pattern."""
        path, fs = self._fs(pattern)
        return [s.getPath().toString() for s in fs.globStatus(path) or []]

    def make(self, path: str) -> None:
        found, fs = self._fs(path)
        fs.mkdirs(found)

    def delete(self, path: str) -> None:
        found, fs = self._fs(path)
        fs.delete(found, True)

    def steps(self, table: str) -> list[int]:
        """Step folders of a table, oldest first."""
        return sorted(int(path.rsplit("=", 1)[1]) for path in self.glob(f"{self.path(table)}/step=*"))

    def write(
        self, df: DataFrame, table: str, step: int, partition_by: Sequence[str] = ()
    ) -> None:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(table, step))

    def clear(self, table: str, step: int) -> None:
        """Drop what an earlier attempt of this step left in a table."""
        self.delete(self.path(table, step))

    def read(
        self, table: str, ddl: str, upto: int | None = None, after: int | None = None
    ) -> DataFrame:
        """Rows of all steps in (after, upto], with the step number."""
        if not self.exists(table):
            return self.spark.createDataFrame([], f"{ddl}, step BIGINT")
        df = self.spark.read.schema(f"{ddl}, step BIGINT").parquet(self.path(table))
        if upto is not None:
            df = df.where(F.col("step") <= upto)
        if after is not None:
            df = df.where(F.col("step") > after)
        return df

    def read_step(self, table: str, ddl: str, step: int | None) -> DataFrame | None:
        """Rows of one step, or None when it wrote none."""
        if step is None or not self.exists(table, step):
            return None
        return self.spark.read.schema(ddl).parquet(self.path(table, step))

    def ledger(self) -> DataFrame:
        return self.committed("ledger", LEDGER_DDL)

    def last_step(self, before: int | None = None) -> int | None:
        """Newest committed step, from folder names; folded steps stay named by their base."""
        done = [s for t in ("ledger", "base/ledger") for s in self.steps(t) if before is None or s < before]
        return max(done, default=None)

    def step_of(self, run: str, batch: int) -> int | None:
        """The committed step of a micro-batch, if there is one."""
        rows = self.ledger().where((F.col("run") == run) & (F.col("batch") == batch))
        return rows.agg(F.max("step")).first()[0]

    def clear_after(self, step: int | None, tables: Sequence[str]) -> None:
        """Drop what steps without a ledger row have left."""
        for table in tables:
            for found in self.steps(table):
                if step is None or found > step:
                    self.clear(table, found)

    def last_base(self, table: str) -> int | None:
        """Newest completely written compaction of a table."""
        for step in reversed(self.steps(f"base/{table}")):
            path, fs = self._fs(f"{self.path(f'base/{table}', step)}/_SUCCESS")
            if fs.exists(path):
                return step
        return None

    def committed(self, table: str, ddl: str) -> DataFrame:
        """All rows readers may see: the newest compacted base and later steps."""
        last = self.last_step()
        if last is None:
            return self.spark.createDataFrame([], f"{ddl}, step BIGINT")
        return self.before(table, ddl, last + 1)

    def before(self, table: str, ddl: str, step: int) -> DataFrame:
        """The newest compacted base and the later steps below ``step``."""
        base = self.last_base(table)
        rows = self.read(table, ddl, upto=step - 1, after=base)
        if base is None:
            return rows
        folded = self.read_step(f"base/{table}", ddl, base)
        return rows.unionByName(folded.withColumn("step", F.lit(base).cast("bigint")))

    def compact(
        self, table: str, merged: DataFrame, upto: int, partition_by: Sequence[str] = ()
    ) -> None:
        """Replace all steps up to ``upto`` by one base holding ``merged``.

        The base is complete before anything is deleted; from then on readers
        skip the steps it covers, deleted or not.
        """
        if self.last_base(table) != upto:
            self.write(merged, f"base/{table}", upto, partition_by)
        for step in self.steps(table):
            if step <= upto:
                self.clear(table, step)
        for step in self.steps(f"base/{table}"):
            if step < upto:
                self.clear(f"base/{table}", step)

    def drop_days(self, table: str, before_day: int, column: str = "business_date") -> int:
        """Delete partitions of days before ``before_day``; returns how many."""
        dropped = 0
        for path in self.glob(f"{self.path(table)}/step=*/{column}=*"):
            day = path.rsplit("=", 1)[1]
            if day.isdigit() and int(day) < before_day:
                self.delete(path)
                dropped += 1
        return dropped
