"""Picking one row (or a few) per key.

Every pick reduces on the map side before the exchange: ``row_number() <= n``
is cut per task by Spark's window group limit, and ``min_by``/``max_by`` are
partial aggregates.  A hot key therefore costs a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col, elapsed
from .series import Ordered


def pick_first(df: DataFrame, keys, order, n: int = 1, ties: bool = False) -> DataFrame:
    """First ``n`` rows per key after sorting by ``order`` (names or sort columns).

    ``ties`` keeps all rows that share the sort values of the n-th row; it needs
    plain ascending column names.
    """
    keys = list(keys)
    if not ties:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(spec)).filter(F.col("_rn") <= n).drop("_rn")
    limits = _values_to_rank(df, keys, order, n).groupBy(*keys).agg(F.max(F.struct(*order)).alias("_limit"))
    limits = limits.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_limit")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(limits, same & (F.struct(*order) <= F.col("_limit"))).select(*df.columns)


def _values_to_rank(df, keys, order, n):
    """Distinct sort values per key whose minimum rank is at most ``n``, with counts."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    counted = df.groupBy(*keys, *order).agg(F.count("*").alias("_c"))
    few = counted.withColumn("_dr", F.row_number().over(spec)).filter(F.col("_dr") <= n)
    before = F.sum("_c").over(spec.rowsBetween(Window.unboundedPreceding, -1))
    return few.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < n).drop("_dr", "_before")


def pick_last(df: DataFrame, keys, order, n: int = 1) -> DataFrame:
    return pick_first(df, keys, [F.desc_nulls_last(c) for c in order], n)


def top_mean(df: DataFrame, keys, value: str, n: int, name: str = "top_mean") -> DataFrame:
    """Mean of the ``n`` largest values per key, values tied with the n-th included."""
    negated = df.select(*keys, (-F.col(value)).alias("_neg")).filter(F.col("_neg").isNotNull())
    top = _values_to_rank(negated, list(keys), ["_neg"], n)
    return top.groupBy(*keys).agg((F.sum(-F.col("_neg") * F.col("_c")) / F.sum("_c")).alias(name))


def nearest(df: DataFrame, keys, ts, anchor, targets_h, values, tie) -> DataFrame:
    """For each target hour after ``anchor`` the values of the row nearest in time.

    One pass for all targets; equal distances go to the earlier row.
    Result columns are ``{value}_{target}h``.
    """
    off = F.unix_micros(ts) - F.unix_micros(anchor)
    picks = {}
    for h in targets_h:
        rank = F.struct(F.abs(off - F.lit(int(h * 3_600_000_000))).alias("d"), F.col(ts), *[F.col(t) for t in tie])
        picks[h] = F.min_by(F.struct(*values), rank).alias(f"_{h}")
    out = df.groupBy(*keys).agg(*picks.values())
    return out.select(*keys, *[F.col(f"_{h}")[v].alias(f"{v}_{h}h") for h in targets_h for v in values])


def keep_first(value, order, tie: str = "min") -> Column:
    """Value at the lowest ``order``; among equal orders the ``tie`` (min or max) of the known values.

    ``tie="max"`` needs a numeric value.
    """
    v = col(value)
    last = v if tie == "min" else -v
    return F.min_by(v, F.struct(*[col(o) for o in order], v.isNull().alias("_n"), last.alias("_v")))


def keep_last(value, order, tie: str = "max") -> Column:
    """Value at the highest ``order``; ``tie="min"`` needs a numeric value."""
    v = col(value)
    last = v if tie == "max" else -v
    return F.max_by(v, F.struct(*[col(o) for o in order], v.isNotNull().alias("_n"), last.alias("_v")))


def with_newest(df: DataFrame, keys, order, cols) -> DataFrame:
    """Put the newest version of ``cols`` within the key on every row (``{col}_newest``)."""
    return Ordered(df, keys, order).whole(**{f"{c}_newest": ("last", c) for c in cols}).result()


def one_per_bucket(df: DataFrame, keys, ts, unit, order) -> DataFrame:
    """First row of each key and hour/day/… of ``ts``."""
    bucket = F.date_trunc(unit, F.col(ts))
    return pick_first(df.withColumn("bucket", bucket), [*keys, "bucket"], order)


def first_when(df: DataFrame, keys, ts, condition: Column, name: str = "first_when") -> DataFrame:
    """First time the condition holds and hours since the key's first row (NULL when never)."""
    hit = F.min(F.when(condition, F.col(ts)))
    return df.groupBy(*keys).agg(hit.alias(name), elapsed(F.min(ts), hit, "hours").alias(f"{name}_hours"))


def single_class(df: DataFrame, keys, label: str) -> DataFrame:
    """Rows of the keys that only ever have one label."""
    spread = df.groupBy(*keys).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    return df.join(spread.filter(F.col("_lo") == F.col("_hi")).select(*keys), list(keys), "left_semi")


def code_set(df: DataFrame, *cols) -> DataFrame:
    """Sorted distinct values."""
    return df.select(*cols).distinct().orderBy(*cols)
