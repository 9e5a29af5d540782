"""Rule classification: the class of the first rule whose every field matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse.schemas import OTHER_CHANNEL

Rules = Mapping[str, Sequence[Mapping[str, Sequence[str]]]]


def rule_list(rules: Rules, class_name: str) -> list[Mapping[str, Sequence[str]]]:
    """All rules of one class."""
    return list(rules.get(class_name, ()))


def classify(
    rules: Rules,
    columns: Mapping[str, str] | None = None,
    default: str = OTHER_CHANNEL,
) -> Column:
    """Compile a rule set to one CASE expression.

    ``rules`` maps a class to its rules; a rule maps a field to its allowed
    values and matches when every field does. Priority is file order. A rule
    without fields never matches. ``columns`` renames rule fields to columns.
    """
    names = columns or {}
    out = None
    for class_name, class_rules in rules.items():
        for rule in class_rules:
            if not rule:
                continue
            hit = F.lit(True)
            for field, allowed in rule.items():
                hit = hit & F.col(names.get(field, field)).isin(*allowed)
            out = F.when(hit, class_name) if out is None else out.when(hit, class_name)
    return F.lit(default) if out is None else out.otherwise(default)


def rule_index(rules: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Each rule under the values of one field, the one that the fewest rules share.

    ``rules`` is the table of :func:`tradepulse.sources.rules.rule_table`. Rows have
    ``field``, ``value``, ``rule_id``, ``class`` and the values allowed of every field, as
    ``_allowed_0`` and so on, null where the rule does not ask. Rules that ask for a field
    beyond ``fields`` can't match and are left out; of rules alike, the first is kept.
    """
    allowed = [f"_allowed_{i}" for i in range(len(fields))]
    asked = [
        F.first(F.when(F.col("field") == f, F.array_sort(F.array_distinct("allowed"))), ignorenulls=True).alias(name)
        for f, name in zip(fields, allowed, strict=True)
    ]
    whole = rules.groupBy("rule_id", "class", "n_fields").agg(*asked)
    known = sum((F.col(name).isNotNull().cast("int") for name in allowed), F.lit(0))
    whole = whole.where((known == F.col("n_fields")) & (F.col("n_fields") > 0))
    whole = whole.groupBy(*allowed).agg(F.min_by("class", "rule_id").alias("class"), F.min("rule_id").alias("rule_id"))

    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(name).alias("values")) for f, name in zip(fields, allowed, strict=True)])
    values = whole.select("rule_id", F.explode(pairs).alias("own")).select(
        "rule_id", F.col("own.field").alias("field"), F.explode("own.values").alias("value")
    )
    shared = values.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n_rules"))
    costs = values.join(shared, ["field", "value"]).groupBy("rule_id", "field").agg(F.sum("n_rules").alias("cost"))
    rarest = costs.groupBy("rule_id").agg(F.min(F.struct("cost", "field"))["field"].alias("field"))
    return values.join(rarest, ["rule_id", "field"]).join(whole, "rule_id")


def rule_candidates(combos: DataFrame, index: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Combinations of values beside the rules that are indexed under one of them."""
    own = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]))
    return combos.select(*fields, own.alias("fv")).select(*fields, "fv.*").join(index, ["field", "value"])


def classify_by_table(
    df: DataFrame,
    rules: DataFrame,
    fields: Sequence[str],
    default: str = OTHER_CHANNEL,
    out: str = "channel",
) -> DataFrame:
    """The same classification for rule sets too long for one CASE.

    Only the distinct value combinations of ``fields`` are classified; the rows
    themselves are joined once. A combination meets the rules that are indexed under one
    of its values, which are few even where most rules share another value; the other
    fields of these are then tested.
    """
    combos = df.select(*fields).distinct()
    tests = F.lit(True)
    for i, f in enumerate(fields):
        allowed = F.col(f"_allowed_{i}")
        tests = tests & (allowed.isNull() | F.coalesce(F.array_contains(allowed, F.col(f)), F.lit(False)))
    hits = rule_candidates(combos, rule_index(rules, fields), fields).where(tests)
    hits = hits.groupBy(*fields).agg(F.min_by("class", "rule_id").alias(out))
    return df.join(hits, list(fields), "left").withColumn(out, F.coalesce(out, F.lit(default)))
