"""Change streams: a message queue, or files of (topic, partition, offset, value)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.schemas import RAW_SCHEMA


def spread(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out to ``partitions`` tasks, where a scan has fewer splits than that.

    For files of one large split, which no reader setting can cut. Left out, the scan
    is taken as it is; queues are cut by the reader (``min_partitions``), files by
    ``spark.sql.files.maxPartitionBytes``.
    """
    if partitions is None or scan.rdd.getNumPartitions() >= partitions:
        return scan
    return scan.repartition(partitions)


def read_change_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of raw messages from parquet files added to a folder."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def kafka_options(
    servers: str,
    topics: Sequence[str],
    starting_offsets: dict[str, dict[str, int]] | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. Stored offsets seed a first start; later the checkpoint rules.

    ``min_partitions`` cuts queue partitions up, so that more tasks parse than a
    topic has partitions.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(dict.fromkeys(topics)),
        "startingOffsets": json.dumps(starting_offsets) if starting_offsets else "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str], **kwargs) -> DataFrame:
    """Stream of raw messages from a queue; needs Spark's Kafka connector jar."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, topics, **kwargs))
        .load()
        .select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    )


def next_offsets(ledger: DataFrame) -> dict[str, dict[str, int]]:
    """Where to resume, per topic and partition, from the batch ledger.

    One row per queue partition reaches the driver, as the reader option needs.
    """
    rows = (
        ledger.where("topic IS NOT NULL AND max_offset IS NOT NULL")
        .groupBy("topic", "partition")
        .agg((F.max("max_offset") + 1).alias("next_offset"))
        .collect()
    )
    out: dict[str, dict[str, int]] = {}
    for row in rows:
        out.setdefault(row["topic"], {})[str(row["partition"])] = row["next_offset"]
    return out
