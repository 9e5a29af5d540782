"""Rule files: class -> list of {field -> allowed values}, as JSON."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.functions.rules import Rules

RULE_DDL = "MAP<STRING, ARRAY<MAP<STRING, ARRAY<STRING>>>>"


def _text(spark: SparkSession, path: str) -> DataFrame:
    """The text of one file; a folder must hold no other, for their order means priority."""
    files = spark.read.text(path, wholetext=True)
    found = len(files.take(2))
    if found != 1:
        raise ValueError(f"{path}: expected one rule file, found {'none' if not found else 'several'}")
    return files


def read_rules(spark: SparkSession, path: str) -> Rules:
    """A rule set as a mapping, for :func:`tradepulse.functions.rules.classify`.

    A rule file is configuration written by hand and fits the driver; a rule
    set kept as data is read with :func:`rule_table` instead.
    """
    return json.loads(_text(spark, path).first()[0])


def read_rule_sets(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, Rules]:
    """Rule sets by name, one ``<name>.json`` each."""
    return {name: read_rules(spark, f"{folder.rstrip('/')}/{name}.json") for name in names}


def rule_table(spark: SparkSession, path: str, rule_set: str) -> DataFrame:
    """The same file as rows (rule_set, class, rule_id, field, n_fields, allowed).

    ``rule_id`` is the file order (class, then rule), so the lowest matching id wins.
    """
    doc = _text(spark, path).select(F.from_json("value", RULE_DDL).alias("doc"))
    classes = doc.select(F.posexplode(F.map_entries("doc")).alias("class_no", "c"))
    rules = classes.select(
        "class_no", F.col("c.key").alias("class"), F.posexplode("c.value").alias("rule_no", "rule")
    )
    return rules.select(
        F.lit(rule_set).alias("rule_set"),
        "class",
        F.struct("class_no", "rule_no").alias("rule_id"),
        F.size("rule").alias("n_fields"),
        F.explode("rule").alias("field", "allowed"),
    ).select("rule_set", "class", "rule_id", "field", "n_fields", "allowed")
