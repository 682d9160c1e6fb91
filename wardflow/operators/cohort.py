"""Cohorts from coded diagnoses, flags, and exclusion rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import classify
from .reshape import flag_pivot


def icd_flags(dx: DataFrame, keys, code: str, mapping: Mapping[str, str], prefix: str = "", fill: bool | None = None) -> DataFrame:
    """Flag columns from a pattern-to-label map, first match wins per row."""
    labelled = dx.withColumn("_label", classify(code, mapping)).filter(F.col("_label").isNotNull())
    return flag_pivot(labelled, keys, "_label", sorted(mapping), prefix, fill)


def cohort(dx: DataFrame, encounters: DataFrame, encounter_id: str, code: str, pattern: str,
           when: Column | None = None, rules: Sequence[Column] = ()) -> DataFrame:
    """Encounters with a matching diagnosis that also meet the encounter ``rules``.

    ``when`` restricts the diagnosis rows (type, priority, vocabulary).  Both
    filters run before the join and reach the scans.
    """
    hits = dx.filter(F.col(code).rlike(pattern))
    hits = hits if when is None else hits.filter(when)
    chosen = encounters
    for rule in rules:
        chosen = chosen.filter(rule)
    return chosen.join(hits.select(encounter_id), encounter_id, "left_semi")


def exclusion_flags(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One boolean column per rule (unknown counts as not excluded) and ``include``."""
    known = {n: F.coalesce(c, F.lit(False)) for n, c in rules.items()}
    kept = F.lit(True)
    for n in rules:
        kept = kept & ~F.col(n)
    return df.withColumns(known).withColumn("include", kept)


def attrition(flagged: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Patients left after each exclusion step, in order, and each rule's own count."""
    left = F.lit(True)
    aggs = [F.count("*").alias("start_left"), F.count("*").alias("start_hit")]
    for n in rules:
        left = left & ~F.col(n)
        aggs += [F.count_if(left).alias(f"{n}_left"), F.count_if(F.col(n)).alias(f"{n}_hit")]
    steps = ["start", *rules]
    rows = F.inline(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("step_no"), F.lit(s).alias("step"),
                 F.col(f"{s}_hit").alias("n_rule"), F.col(f"{s}_left").alias("n_left"))
        for i, s in enumerate(steps)
    ]))
    return flagged.agg(*aggs).select(rows)


def exclusion_cascade(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows with no exclusion, and the attrition table."""
    flagged = exclusion_flags(df, rules)
    return flagged.filter("include").drop(*rules, "include"), attrition(flagged, list(rules))
