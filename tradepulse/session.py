"""Session defaults and the shared work folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession

# Settings a cluster run should carry. Shuffle partitions are left to the
# cluster: adaptive execution coalesces from whatever initial number it sets.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # a micro-batch runs more compiled classes than the default cache of 100 keeps
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(app_name: str = "tradepulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Drops the shuffle files of a statement when it ends, and not when the driver next collects garbage.
SHUFFLES_END = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextlib.contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold within the block; a stream started there keeps them."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@functools.cache
def _own_folder() -> tempfile.TemporaryDirectory:
    """One temporary folder per process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="tradepulse-", ignore_cleanup_errors=True)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables and checkpoints of one run.

    Lies under ``spark.checkpoint.dir``, the folder all executors share. Only
    where one JVM is both driver and executor, and that setting is missing, the
    process has a temporary folder for it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not shared and (master == "local" or master.startswith("local[")):
        shared = _own_folder().name
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{shared.rstrip('/')}/tradepulse/{name}-{uuid.uuid4().hex}"
