"""Summaries, exact quantiles, frequency tables and two-group comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col
from .series import Ordered
from .skew import find_cuts


def complete(c: str, agg: Column) -> Column:
    """Aggregate that is NULL when any value of ``c`` is (no NA skipping)."""
    return F.when(F.count(c) == F.count("*"), agg)


# ------------------------------------------------------------- exact quantiles

def exact_quantiles(df: DataFrame, keys, value: str, shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles with linear interpolation between order statistics, exact.

    The built-in percentile keeps every distinct value of a group in memory, so
    hot groups take another road: counts per distinct value, a running count
    over the (chunked) sorted values, and the two order statistics around each
    quantile.
    """
    keys = list(keys)
    cuts = find_cuts(df.filter(F.col(value).isNotNull()), keys, value)
    built_in = [F.percentile(value, float(q)).alias(n) for q, n in zip(shares, names)]
    if cuts is None:
        return df.groupBy(*keys).agg(*built_in)
    marked = cuts.mark(df.select(*keys, value), keys, F.col(value)).withColumnRenamed("_hot", "_is_hot").drop("_h", "_chunk")
    cold = marked.filter(~F.col("_is_hot")).groupBy(*keys).agg(*built_in) if keys else None
    counted = (
        marked.filter("_is_hot").filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    )
    o = Ordered(counted, keys, [value], cuts).look(_upto=("sum", "_c")).whole(_n=("sum", "_c"))
    ranked = o.result()
    picks = []
    for q, n in zip(shares, names):
        at = (F.col("_n") - 1) * F.lit(float(q))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{side}_{n}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_w_{n}"))
    hot = ranked.groupBy(*keys).agg(*picks).select(
        *keys,
        *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n) for n in names],
    )
    return hot if cold is None else cold.unionByName(hot)


def summary_stats(df: DataFrame, keys, value: str, prefix: str = "", shares=(0.25, 0.5, 0.75),
                  names=("q25", "median", "q75")) -> DataFrame:
    """Count, mean, sd, quantiles and interquartile range of one column per key."""
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull())
    plain = [F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")]
    if find_cuts(rows, keys, value) is None:
        out = rows.groupBy(*keys).agg(*plain, *[F.percentile(value, float(q)).alias(n) for q, n in zip(shares, names)])
    else:
        base = rows.groupBy(*keys).agg(*plain)
        quant = exact_quantiles(rows, keys, value, shares, names)
        if keys:
            other = quant.withColumnsRenamed({k: f"_k_{k}" for k in keys})
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            out = base.join(other, same).drop(*[f"_k_{k}" for k in keys])
        else:
            out = base.withColumn("_one", F.lit(1)).join(quant.withColumn("_one", F.lit(1)), "_one").drop("_one")
    if {"q25", "q75"} <= set(names):
        out = out.withColumn("iqr", F.col("q75") - F.col("q25"))
    return out.withColumnsRenamed({c: f"{prefix}{c}" for c in out.columns if c not in keys}) if prefix else out


def five_number(df: DataFrame, keys, value: str) -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    return exact_quantiles(df, keys, value, (0, 0.25, 0.5, 0.75, 1), ("low", "q25", "median", "q75", "high"))


def histogram(df: DataFrame, keys, value: str, width: float) -> DataFrame:
    """Counts in bins ``[k*width, (k+1)*width)``."""
    bin_ = (F.floor(F.col(value) / F.lit(float(width))) * F.lit(float(width))).alias("bin")
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, bin_).agg(F.count("*").alias("n"))


def profile(df: DataFrame, keys, at: Column, width: float, value: str) -> DataFrame:
    """Mean and median of ``value`` per group and bin of elapsed time.

    A binned profile, not a fitted curve.
    """
    rows = df.withColumn("bin", F.floor(at / F.lit(float(width))) * F.lit(float(width)))
    return summary_stats(rows, [*keys, "bin"], value, shares=(0.5,), names=("median",))


def control_limits(df: DataFrame, keys, order, value: str) -> DataFrame:
    """Individuals chart: centre and mean +/- 2.66 mean moving ranges."""
    o = Ordered(df, keys, order).look(_pv=("lag", value))
    moving = F.avg(F.abs(F.col(value) - F.col("_pv")))
    return o.result().groupBy(*keys).agg(
        F.avg(value).alias("centre"),
        moving.alias("mean_range"),
        (F.avg(value) - 2.66 * moving).alias("lower"),
        (F.avg(value) + 2.66 * moving).alias("upper"),
    )


def rank_sum(df: DataFrame, group: str, first: str, second: str, value: str, by=()) -> DataFrame:
    """Two-group rank-sum test per ``by``: U of ``first``, z and an approximate p.

    Mid-ranks come from counts per distinct value and a running count, with the
    tie correction and a continuity correction in the normal approximation.
    """
    by = list(by)
    rows = df.filter(F.col(value).isNotNull() & F.col(group).isin(first, second))
    counted = rows.groupBy(*by, value).agg(
        F.count_if(F.col(group) == first).alias("_a"), F.count_if(F.col(group) == second).alias("_b")
    ).withColumn("_t", F.col("_a") + F.col("_b"))
    ranked = Ordered(counted, by, [value]).look(_upto=("sum", "_t")).result()
    mid = F.col("_upto") - F.col("_t") + (F.col("_t") + 1) / 2
    t = F.col("_t").cast("double")
    sums = ranked.groupBy(*by).agg(
        F.sum("_a").alias("n_first"), F.sum("_b").alias("n_second"),
        F.sum(F.col("_a") * mid).alias("_r"), F.sum(t * t * t - t).alias("_ties"),
    )
    a, b = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    n = a + b
    u = F.col("_r") - a * (a + 1) / 2
    var = a * b / 12 * (n + 1 - F.col("_ties") / F.nullif(n * (n - 1), F.lit(0.0)))
    dev = u - a * b / 2
    z = (dev - F.signum(dev) * 0.5) / F.nullif(F.sqrt(var), F.lit(0.0))
    out = sums.select(*by, "n_first", "n_second", u.alias("u"), z.alias("z"))
    return out.withColumn("p_approx", normal_tail(F.abs(F.col("z"))) * 2)


def normal_tail(x: Column) -> Column:
    """Upper tail of the standard normal (a rational approximation, error below 1e-7)."""
    # Coefficients of the published approximation.
    c = [0.31938153, -0.356563782, 1.781477937, -1.821255978, 1.330274429]
    k = 1 / (1 + 0.2316419 * x)
    poly = None
    for coefficient in reversed(c):
        poly = F.lit(coefficient) * k if poly is None else (F.lit(coefficient) + poly) * k
    return F.least(F.lit(0.5), F.exp(-x * x / 2) / F.sqrt(F.lit(2 * 3.141592653589793)) * poly)


# ---------------------------------------------------------- counts and tables

def frequency_table(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of each ``row`` value per group, zero filled, with the total."""
    out = df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v.lower()}") for v in values], F.count("*").alias("n"))
    return out


def overlap_rate(before: DataFrame, during: DataFrame, keys, item: str) -> DataFrame:
    """Items had before, items had during, both, and the share of the former continued, per key."""
    keys = list(keys)
    rows = before.select(*keys, item, F.lit(True).alias("_home")).unionByName(during.select(*keys, item, F.lit(False).alias("_home")))
    return overlap_of(rows, keys, item, F.col("_home"), ~F.col("_home"))


def overlap_of(rows: DataFrame, keys, item: str, before: Column, during: Column) -> DataFrame:
    """As :func:`overlap_rate`, of rows that tell themselves on which side they are (or on both): one pass."""
    keys = list(keys)
    rows = rows.select(*keys, item, before.cast("int").alias("_a"), during.cast("int").alias("_b")).filter("_a = 1 or _b = 1")
    per_item = rows.groupBy(*keys, item).agg(F.max(F.coalesce("_a", F.lit(0))).alias("_a"), F.max(F.coalesce("_b", F.lit(0))).alias("_b"))
    kept = F.sum(F.col("_a") * F.col("_b"))
    return per_item.groupBy(*keys).agg(
        F.count("*").alias("n_items"), F.sum("_a").alias("n_before"), F.sum("_b").alias("n_during"),
        kept.alias("n_both"), (kept / F.nullif(F.sum("_a"), F.lit(0))).alias("share_continued"),
    )


def text_list(df: DataFrame, keys, text: str, order=(), sep: str = ", ", name: str = "items") -> DataFrame:
    """Distinct (order, text) entries of a key joined into one text, sorted by ``order`` then text.

    Duplicates go before the exchange, so a list is as long as its distinct
    entries, not as the rows of its key.
    """
    keys, order = list(keys), list(order)
    entries = df.filter(F.col(text).isNotNull()).select(*keys, *order, text).distinct()
    placed = Ordered(entries, keys, [*dict.fromkeys([*order, text])])
    sorted_ = F.array_sort(F.collect_list(F.struct(*order, text)))
    piece = F.array_join(F.transform(sorted_, lambda e: e[text]), sep)
    if placed.cuts is None:
        return entries.groupBy(*keys).agg(piece.alias(name))
    # A hot key is sorted and joined chunk by chunk; only the finished pieces meet.
    pieces = placed.df.groupBy(*keys, "_chunk").agg(piece.alias("_piece"))
    whole = F.array_sort(F.collect_list(F.struct("_chunk", "_piece")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(whole, lambda e: e["_piece"]), sep).alias(name))


def baseline_to_window(rows: DataFrame, keys, value: str, baseline: Column, window: Column, n: int, names=("top_mean", "later_mean")) -> DataFrame:
    """Mean of the ``n`` largest baseline values (ties kept) and mean of a later window; keys that have both.

    One pass: the rank is taken among the baseline rows of the key, and both
    means come from the same aggregate.
    """
    marked = rows.select(*keys, value, baseline.alias("_base"), window.alias("_window")).filter("_base or _window")
    order = Window.partitionBy(*keys, "_base").orderBy(F.desc(value))
    ranked = marked.withColumn("_rank", F.rank().over(order))
    out = ranked.groupBy(*keys).agg(
        F.avg(F.when(F.col("_base") & (F.col("_rank") <= n), F.col(value))).alias(names[0]), F.avg(F.when(F.col("_window"), F.col(value))).alias(names[1]),
        F.bool_or("_base").alias("_b"), F.bool_or("_window").alias("_w"),
    )
    return out.filter("_b and _w").drop("_b", "_w")


def days_with(df: DataFrame, keys, ts: str, name: str = "n_days") -> DataFrame:
    """Distinct days with at least one row."""
    return df.groupBy(*keys).agg(F.count_distinct(F.to_date(ts)).alias(name))


def extreme_with_time(df: DataFrame, keys, ts: str, value: str, anchor: str, tie) -> DataFrame:
    """Largest value and the day (from ``anchor``) it first occurred."""
    from ..functions.scalar import hosp_day

    best = F.max_by(F.struct(F.col(value).alias("v"), hosp_day(ts, anchor).alias("d")),
                    F.struct(F.col(value), (-F.unix_micros(ts)).alias("_t"), *[(-F.col(t)).alias(f"_{t}") for t in tie]))
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(best.alias("_b")).select(
        *keys, F.col("_b")["v"].alias(f"max_{value}"), F.col("_b")["d"].alias("max_day")
    )


def max_per_weight(df: DataFrame, keys, dose, *weights) -> DataFrame:
    """Largest dose per weight, the weight being the first known of ``weights``."""
    weight = F.nullif(F.coalesce(*[col(w) for w in weights]), F.lit(0.0))
    return df.groupBy(*keys).agg(F.max(col(dose) / weight).alias("max_dose_per_kg"))


def share_beyond(df: DataFrame, keys, condition: Column, name: str = "pct_beyond") -> DataFrame:
    """Percent of readings that meet the condition."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(condition).alias("n_beyond"),
        (F.count_if(condition) / F.count("*") * 100).alias(name),
    )


def last_hours(df: DataFrame, keys, ts: str, hours: float, tie) -> DataFrame:
    """Rows in the ``hours`` before the key's last row."""
    from ..functions.scalar import elapsed

    o = Ordered(df, keys, [ts, *tie]).whole(_end=("max", ts))
    return o.result().filter(elapsed(ts, "_end", "hours") <= hours).drop("_end")


def part_of_total(df: DataFrame, keys, order, value: str, name: str = "share") -> DataFrame:
    """Each row's share of its key's total."""
    o = Ordered(df, keys, order).whole(_total=("sum", value))
    return o.result().withColumn(name, F.col(value) / F.nullif(F.col("_total"), F.lit(0.0))).drop("_total")
