"""Dose courses, infusion runs and series summaries.

A new dose course starts after a gap above ``gap_hours``; a new infusion run
after a gap above ``drip_off`` hours.  Both limits are parameters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import elapsed
from .series import Ordered, ordered, rolling_drop


def _numbered(df, keys, ts, tie, gap_hours, name):
    o = Ordered(df, keys, [ts, *tie]).look(_pt=("lag", ts))
    gap = elapsed("_pt", ts, "hours")
    o = o.with_columns({"_new": (gap.isNull() | (gap > gap_hours)).cast("bigint")}).look(**{name: ("sum", "_new")})
    return o


def med_runtime(df: DataFrame, keys, ts: str, dose: str, tie=(), gap_hours: float = 24.0) -> DataFrame:
    """Dose courses per key (encounter, medication, …)."""
    rows = _numbered(df, list(keys), ts, tie, gap_hours, "course_count").result()
    place = F.struct(ts, *tie)
    return rows.groupBy(*keys, "course_count").agg(
        F.min(ts).alias("dose_start"),
        F.max(ts).alias("dose_stop"),
        F.count("*").alias("num_doses"),
        elapsed(F.min(ts), F.max(ts), "hours").alias("duration"),
        F.min_by(dose, place).alias("first_dose"),
        F.max_by(dose, place).alias("last_dose"),
        F.max(dose).alias("max_dose"),
        F.avg(dose).alias("avg_dose"),
    )


def drip_runtime(df: DataFrame, keys, ts: str, rate: str, tie=(), drip_off: float = 12.0) -> DataFrame:
    """Infusion rows with their run: number, start, stop, hours since start,
    hours until the next row of the run, and the rate carried forward."""
    keys = list(keys)
    o = _numbered(df, keys, ts, tie, drip_off, "drip_count")
    rows = o.result().drop("_pt", "_new")
    run = Ordered(rows, [*keys, "drip_count"], [ts, *tie], o.cuts, keys)
    run = run.look(rate_filled=("last", rate), _nt=("lead", ts)).whole(drip_start=("min", ts), drip_stop=("max", ts))
    return run.result().withColumns({
        "run_time": elapsed("drip_start", ts, "hours"),
        "duration": F.coalesce(elapsed(ts, "_nt", "hours"), F.lit(0.0)),
    }).drop("_nt")


def summarize_drips(runs: DataFrame, keys, ts: str, tie=()) -> DataFrame:
    """One row per infusion run from :func:`drip_runtime`; run time counts rates above zero."""
    place = F.struct(ts, *tie)
    rate, hours = F.col("rate_filled"), F.col("duration")
    return runs.groupBy(*keys, "drip_count").agg(
        F.min(ts).alias("start_datetime"),
        F.max(ts).alias("stop_datetime"),
        elapsed(F.min(ts), F.max(ts), "hours").alias("duration"),
        F.min_by("rate_filled", place).alias("first_rate"),
        F.max_by("rate_filled", place).alias("last_rate"),
        F.max("rate_filled").alias("max_rate"),
        (F.sum(rate * hours) / F.nullif(F.sum(F.when(rate.isNotNull(), hours)), F.lit(0.0))).alias("time_wt_avg_rate"),
        F.coalesce(F.sum(F.when(rate > 0, hours)), F.lit(0.0)).alias("infusion_run_time"),
    )


def series_summary(df: DataFrame, keys, ts: str, value: str, tie=()) -> DataFrame:
    """Summary of a series per key (encounter, or encounter and day)."""
    o = ordered(df, keys, [ts, *tie]).look(_pv=("lag", value), _pt=("lag", ts))
    place = F.struct(ts, *tie)
    area = F.coalesce(F.sum((F.col(value) + F.col("_pv")) / 2 * elapsed("_pt", ts, "hours")), F.lit(0.0))
    span = elapsed(F.min(ts), F.max(ts), "hours")
    rows = o.result()
    base = rows.groupBy(*keys).agg(
        F.min(ts).alias("first_datetime"),
        F.max(ts).alias("last_datetime"),
        F.min_by(value, place).alias("first_result"),
        F.max_by(value, place).alias("last_result"),
        F.min(value).alias("min_result"),
        F.max(value).alias("max_result"),
        F.sum(value).alias("cum_sum"),
        area.alias("auc"),
        span.alias("duration"),
        *([F.percentile(value, 0.5).alias("median_result")] if o.cuts is None else []),
    ).withColumn("time_wt_avg", F.col("auc") / F.nullif(F.col("duration"), F.lit(0.0)))
    if o.cuts is None:
        return base
    from .agg import exact_quantiles

    med = exact_quantiles(df.result() if isinstance(df, Ordered) else df, keys, value, (0.5,), ("median_result",))
    # null-safe: a group with an unknown key has a median too
    med = med.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))
    return base.join(med, same, "left").drop(*[f"_k_{k}" for k in keys])


def lab_change(df: DataFrame, keys, ts: str, value: str, change_by: float = -2.0, fn: str = "max", back: float = 2.0) -> DataFrame:
    """Rows that fell by ``-change_by`` against the ``fn`` of the previous ``back`` days."""
    return rolling_drop(df, keys, ts, value, back, change_by, fn, "change")
