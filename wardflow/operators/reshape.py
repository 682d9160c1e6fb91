"""Long to wide, wide to long, and list cells.

Every pivot gets its value list, so the schema is stable and no job runs to
discover it.  Pivots are conditional aggregates with a partial step per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .agg import exact_quantiles


def flag_pivot(df: DataFrame, keys, name: str, values: Sequence, prefix: str = "", fill: bool | None = None) -> DataFrame:
    """One boolean column per value: TRUE where the key has a row with it."""
    flags = [F.max(F.when(F.col(name) == v, F.lit(True))).alias(f"{prefix}{v}") for v in values]
    out = df.groupBy(*keys).agg(*flags)
    if fill is None:
        return out
    return out.withColumns({f"{prefix}{v}": F.coalesce(F.col(f"{prefix}{v}"), F.lit(fill)) for v in values})


def value_pivot(df: DataFrame, keys, name, values: Sequence, value: str, order=None, names: str = "{name}", fill=None) -> DataFrame:
    """One column per ``name`` value with the (first by ``order``) ``value``.

    ``name`` may be several columns; their texts are joined with an underscore.
    """
    label = F.concat_ws("_", *[F.col(n).cast("string") for n in name]) if isinstance(name, (list, tuple)) else F.col(name)
    cols = []
    for v in values:
        hit = label == F.lit(v)
        one = F.max(F.when(hit, F.col(value))) if order is None else F.min_by(
            F.col(value), F.when(hit, F.struct(*order))
        )
        cols.append((one if fill is None else F.coalesce(one, F.lit(fill))).alias(names.format(name=v)))
    return df.groupBy(*keys).agg(*cols)


def measures_pivot(df: DataFrame, keys, name: str, values: Sequence, aggs: Mapping[str, Column], names: str = "{name}_{value}") -> DataFrame:
    """Several aggregates per ``name`` value."""
    wide = df.groupBy(*keys).pivot(name, list(values)).agg(*[a.alias(n) for n, a in aggs.items()])
    if len(aggs) == 1:
        only = next(iter(aggs))
        return wide.withColumnsRenamed({str(v): names.format(name=v, value=only) for v in values})
    return wide.withColumnsRenamed({f"{v}_{n}": names.format(name=v, value=n) for v in values for n in aggs})


def to_long(df: DataFrame, ids, cols: Sequence[str], name: str = "name", value: str = "value", keep: Column | None = None) -> DataFrame:
    out = df.unpivot(list(ids), list(cols), name, value)
    return out if keep is None else out.filter(keep)


def statistics_table(df: DataFrame, cols: Sequence[str], aggs: Mapping[str, str], quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """One row per measure, one column per statistic.

    ``aggs`` maps a statistic to an aggregate of ``value``, e.g. ``{"mean": "avg(value)"}``;
    ``quantiles`` maps a name to a share, e.g. ``{"median": 0.5}``.
    """
    long = df.select(*[F.col(c).cast("double") for c in cols]).unpivot([], list(cols), "measure", "value")
    out = long.groupBy("measure").agg(*[F.expr(text).alias(n) for n, text in aggs.items()])
    if not quantiles:
        return out
    return out.join(exact_quantiles(long, ["measure"], "value", list(quantiles.values()), list(quantiles)), "measure")


def split_column(df: DataFrame, column: str, into: Sequence[str], sep: str) -> DataFrame:
    parts = F.split(F.col(column), sep, len(into))
    return df.withColumns({n: F.get(parts, i) for i, n in enumerate(into)}).drop(column)


def unite_columns(df: DataFrame, name: str, cols: Sequence[str], sep: str = "_") -> DataFrame:
    return df.withColumn(name, F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])).drop(*cols)


def explode_list(df: DataFrame, column: str, name: str, sep: str = "\r?\n") -> DataFrame:
    """One row per entry of a delimited cell; blank entries are dropped."""
    out = df.withColumn(name, F.explode(F.split(F.col(column), sep))).drop(column)
    return out.withColumn(name, F.trim(name)).filter(F.col(name) != "")


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a part lacks are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def membership(parts: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per key of any part, one boolean column per part."""
    tagged = stack([df.select(key).withColumn("_part", F.lit(n)) for n, df in parts.items()])
    return flag_pivot(tagged, [key], "_part", list(parts), fill=False)
