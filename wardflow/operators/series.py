"""Ordered work inside a key: neighbours, running values, islands, sessions,
pairs, rolling windows and measures over irregular series.

:class:`Ordered` is the base.  Without hot keys it is plain window functions
that share one exchange and one sort.  With hot keys it works per
(key, chunk) and adds what the earlier (or later) chunks of the key
contribute: that is one small row per chunk, computed with a partial
aggregate and sent to the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import elapsed
from .skew import Cuts, find_cuts, order_number, setting

LOOK = ("lag", "lead", "sum", "max", "min", "last")
WHOLE = ("first", "last", "sum", "max", "min", "count")


class Ordered:
    """Rows of each key in a total order ``order`` (first a time or number, then tie-breaks)."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], cuts: Cuts | None | str = "find",
                 cut_keys: list[str] | None = None, backward: bool = False):
        """``cuts`` found for ``cut_keys`` (a subset of ``keys``) can be passed on to a finer grouping.

        ``backward`` walks the same order from its end.
        """
        self.backward = backward
        self.keys = list(keys)
        self.order = list(order)
        second = self.order[1] if len(self.order) > 1 else None
        self._tie = second if second and df.schema[second].dataType.typeName() in _CUTTABLE else None
        if cuts == "find":
            cuts = find_cuts(df, self.keys, self.order[0], self._tie)
        self.cuts = cuts
        if cuts is not None:
            at = order_number(df, self.order[0])
            tie_at = order_number(df, self._tie) if self._tie else None
            df = cuts.mark(df, cut_keys or self.keys, at, tie_at)
        self.df = df

    @property
    def parts(self) -> list[str]:
        """Columns that bound one task's group."""
        return self.keys + (["_chunk"] if self.cuts is not None else [])

    def _spec(self):
        parts = self.parts or [F.lit(0)]
        return Window.partitionBy(*parts).orderBy(*(map(F.desc, self.order) if self.backward else self.order))

    def result(self) -> DataFrame:
        return self.df.drop("_h", "_chunk", "_hot") if self.cuts is not None else self.df

    def _with(self, df: DataFrame) -> "Ordered":
        out = object.__new__(Ordered)
        out.keys, out.order, out.cuts, out._tie, out.df = self.keys, self.order, self.cuts, self._tie, df
        out.backward = self.backward
        return out

    def with_columns(self, columns: dict[str, Column]) -> "Ordered":
        return self._with(self.df.withColumns(columns))

    def filter(self, condition) -> "Ordered":
        return self._with(self.df.filter(condition))

    def look(self, **outs: tuple[str, Column | str]) -> "Ordered":
        """Add columns that depend on the neighbours or on all rows so far.

        ``new=("lag"|"lead", c)`` neighbour value; ``("sum"|"max"|"min", c)``
        running value including this row; ``("last", c)`` latest non-null so far.
        """
        cols = {n: (kind, F.col(c) if isinstance(c, str) else c) for n, (kind, c) in outs.items()}
        spec = self._spec()
        upto = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if self.cuts is None:
            return self._with(self.df.withColumns({n: _inside(k, c, spec, upto) for n, (k, c) in cols.items()}))

        # What every chunk of a hot key hands to the next ones.
        place = F.struct(*self.order)
        base = self.df.withColumns({f"_v_{n}": c for n, (_, c) in cols.items()})
        ends = (
            base.filter("_hot")
            .groupBy("_h", *self.keys, "_chunk")
            .agg(*[_end(k, F.col(f"_v_{n}"), place, self.backward).alias(f"_e_{n}") for n, (k, _) in cols.items()])
        )
        along = Window.partitionBy("_h", *self.keys).orderBy(F.desc("_chunk") if self.backward else "_chunk")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(
            *[F.col(c).alias(f"_k_{c}") for c in ["_h", *self.keys, "_chunk"]],
            *[_handover(k, F.col(f"_e_{n}"), along, before).alias(f"_c_{n}") for n, (k, _) in cols.items()],
        )
        same = F.lit(True)
        for c in ["_h", *self.keys, "_chunk"]:
            same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        mine = {}
        for n, (k, _) in cols.items():
            v = F.col(f"_v_{n}")
            # a struct tells "no neighbour" from "neighbour with a null value"
            mine[f"_i_{n}"] = _inside(k, F.struct(v.alias("v")) if k in ("lag", "lead") else v, spec, upto)
        joined = base.withColumns(mine).join(carry, same, "left")
        done = joined.withColumns({n: _merge(k, F.col(f"_i_{n}"), F.col(f"_c_{n}")) for n, (k, _) in cols.items()})
        keep = [c for c in self.df.columns if c not in cols] + list(cols)
        return self._with(done.select(*keep))

    def whole(self, **outs: tuple[str, Column | str]) -> "Ordered":
        """Add per-key values (``first, last, sum, max, min, count``) to every row.

        First and last are those of the forward order.
        """
        if self.backward:
            raise ValueError("whole() reads the forward order")
        cols = {n: (kind, F.col(c) if isinstance(c, str) else c) for n, (kind, c) in outs.items()}
        place = F.struct(*self.order)
        if self.cuts is None:
            # same ordering as look(), so both share one sort
            frame = self._spec().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            over = {
                n: (F.first(c).over(frame) if k == "first" else F.last(c).over(frame) if k == "last" else
                    getattr(F, k)(c).over(frame))
                for n, (k, c) in cols.items()
            }
            return self._with(self.df.withColumns(over))
        base = self.df.withColumns({f"_v_{n}": c for n, (_, c) in cols.items()})
        # Cold keys have one chunk and hot keys few: pre-aggregate per chunk, then per key.
        aggs = [_whole(k, F.col(f"_v_{n}"), place).alias(f"_t_{n}") for n, (k, _) in cols.items()]
        totals = base.filter("_hot").groupBy("_h", *self.keys).agg(*aggs)
        totals = totals.select(
            *[F.col(c).alias(f"_k_{c}") for c in ["_h", *self.keys]], *[F.col(f"_t_{n}") for n in cols]
        )
        same = F.lit(True)
        for c in ["_h", *self.keys]:
            same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        frame = self._spec().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        local = {}
        for n, (k, _) in cols.items():
            v = F.col(f"_v_{n}")
            local[f"_i_{n}"] = (F.first(v) if k == "first" else F.last(v) if k == "last" else getattr(F, k)(v)).over(frame)
        joined = base.withColumns(local).join(totals, same, "left")
        done = joined.withColumns(
            {
                n: F.when(F.col("_hot"), F.col(f"_t_{n}")["v"] if k in ("first", "last") else F.col(f"_t_{n}"))
                .otherwise(F.col(f"_i_{n}"))
                for n, (k, _) in cols.items()
            }
        )
        keep = [c for c in self.df.columns if c not in cols] + list(cols)
        return self._with(done.select(*keep))


def ordered(rows: DataFrame | Ordered, keys, order) -> Ordered:
    """``rows`` in the order of ``keys``: one that is ordered so already keeps its cuts and chunk marks.

    Operators that take it can be chained on one :class:`Ordered`, which looks
    for hot keys once and marks the chunks once.  Cuts of a key hold for a finer
    key and for a part of its rows.
    """
    keys, order = list(keys), list(order)
    if not isinstance(rows, Ordered):
        return Ordered(rows, keys, order)
    if rows.backward or rows.order != order or not set(rows.keys) <= set(keys):
        return Ordered(rows.result(), keys, order)
    return rows if rows.keys == keys else Ordered(rows.result(), keys, order, rows.cuts, rows.keys)


_CUTTABLE = ("byte", "short", "integer", "long", "float", "double", "timestamp", "date", "string", "binary")


def _inside(kind, c, spec, upto):
    if kind in ("lag", "lead"):
        return getattr(F, kind)(c).over(spec)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(upto)
    return getattr(F, kind)(c).over(upto)


def _end(kind, v, place, backward):
    newest, oldest = (F.min_by, F.max_by) if backward else (F.max_by, F.min_by)
    if kind == "lag":
        return newest(F.struct(v.alias("v")), place)
    if kind == "lead":
        return oldest(F.struct(v.alias("v")), place)
    if kind == "last":
        return newest(v, F.when(v.isNotNull(), place))
    return getattr(F, kind)(v)


def _handover(kind, e, along, before):
    if kind in ("lag", "lead"):
        return getattr(F, kind)(e).over(along)
    if kind == "last":
        return F.last(e, ignorenulls=True).over(before)
    return getattr(F, kind)(e).over(before)


def _merge(kind, mine, carried):
    if kind in ("lag", "lead"):
        return F.coalesce(mine, carried)["v"]
    if kind == "last":
        return F.coalesce(mine, carried)
    if kind == "sum":
        return F.coalesce(mine + carried, mine, carried)
    return F.greatest(mine, carried) if kind == "max" else F.least(mine, carried)


def _whole(kind, v, place):
    if kind == "first":
        return F.min_by(F.struct(v.alias("v")), place)
    if kind == "last":
        return F.max_by(F.struct(v.alias("v")), place)
    return getattr(F, kind)(v)


# ---------------------------------------------------------------- neighbours

def neighbours(df, keys, order, **outs):
    """``new=("lag"|"lead", column)`` in one pass."""
    return ordered(df, keys, order).look(**outs).result()


def time_to_next(df, keys, ts, tie, unit="hours", last=1.0, name="duration"):
    """Time until the next reading of the key; the last reading counts ``last``."""
    o = ordered(df, keys, [ts, *tie]).look(_next=("lead", ts))
    return o.result().withColumn(name, F.coalesce(elapsed(ts, "_next", unit), F.lit(float(last)))).drop("_next")


def changes(df, keys, ts, tie, value):
    """Change from the previous and the first reading, relative change, and change per hour."""
    o = ordered(df, keys, [ts, *tie]).look(_pv=("lag", value), _pt=("lag", ts)).whole(_fv=("first", value))
    gap = elapsed("_pt", ts, "hours")
    return o.result().select(
        *df.columns,
        (F.col(value) - F.col("_pv")).alias("chg_prev"),
        (F.col(value) - F.col("_fv")).alias("chg_first"),
        ((F.col(value) - F.col("_fv")) / F.nullif(F.col("_fv"), F.lit(0.0))).alias("chg_first_pct"),
        F.when(gap > 0, (F.col(value) - F.col("_pv")) / gap).alias("chg_per_hour"),
    )


def consecutive_below(df, keys, ts, tie, value, limit, name="two_below"):
    """Flag rows where this and the previous reading are below ``limit``."""
    o = ordered(df, keys, [ts, *tie]).look(_pv=("lag", value))
    return o.result().withColumn(name, F.coalesce((F.col(value) < limit) & (F.col("_pv") < limit), F.lit(False))).drop("_pv")


def running(df, keys, order, **outs):
    """Running ``sum``/``max``/``min``/``last`` columns."""
    return ordered(df, keys, order).look(**outs).result()


def sequence_number(df, keys, order, name="n"):
    """1, 2, 3 … within the key."""
    return running(df, keys, order, **{name: ("sum", F.lit(1).cast("bigint"))})


def since_first(df, keys, ts, tie, unit="hours", name="elapsed"):
    """Time since the key's first reading."""
    o = ordered(df, keys, [ts, *tie]).whole(_first=("min", ts))
    return o.result().withColumn(name, elapsed("_first", ts, unit)).drop("_first")


# ------------------------------------------------------- islands and sessions

def islands(df, keys, order, label, name="island"):
    """Number the runs of equal ``label`` inside a key (1, 2, …); nulls form runs too."""
    o = ordered(df, keys, order).look(_pl=("lag", F.struct(F.col(label).alias("v"))))
    fresh = F.col("_pl").isNull() | ~F.col(label).eqNullSafe(F.col("_pl")["v"])
    o = o.with_columns({"_new": fresh.cast("bigint")}).look(**{name: ("sum", "_new")})
    return o.result().drop("_pl", "_new")


def stays(df, keys, start, stop, unit, tie, until=None, min_minutes=1.0):
    """Unit stays from a location history.

    Rows shorter than ``min_minutes`` are ignored; consecutive rows in the same
    unit become one stay with its first entry, latest exit and summed days.
    ``until`` (e.g. discharge) bounds the length of a row; as in the warehouse,
    an unknown end or bound leaves the length unknown and drops the row.
    """
    end = F.col(stop)
    if until:
        end = F.when(end.isNotNull() & F.col(until).isNotNull(), F.least(end, F.col(until)))
    rows = ordered(df, keys, [start, *tie])
    if until:
        rows = rows.filter(F.col(until) >= F.col(start))
    rows = rows.with_columns({"_len": elapsed(F.col(start), end, "days")}).filter(F.col("_len") >= min_minutes / 1440)
    return (
        islands(rows, keys, [start, *tie], unit, "unit_count")
        .groupBy(*keys, "unit_count", unit)
        .agg(
            F.min(start).alias("unit_in_datetime"),
            F.max(stop).alias("unit_out_datetime"),
            F.sum("_len").alias("unit_los"),
        )
    )


def sessions(df, keys, start, stop, tie, gap_hours):
    """Merge intervals of a key: a new session starts after a gap above ``gap_hours``.

    The gap is measured from the end of the previous row; an unknown previous
    end starts a new session.  The session ends where its last row ends, and
    sessions with an unknown end are dropped.
    """
    o = ordered(df, keys, [start, *tie]).look(_pe=("lag", stop))
    gap = elapsed("_pe", start, "hours")
    o = o.with_columns({"_new": (gap.isNull() | (gap > gap_hours)).cast("bigint")}).look(session=("sum", "_new"))
    return (
        o.result()
        .groupBy(*keys, "session")
        .agg(
            F.min(start).alias("session_start"),
            F.max_by(stop, F.struct(start, *tie)).alias("session_end"),
            F.count("*").alias("n_rows"),
        )
        .filter(F.col("session_end").isNotNull())
    )


def pair_events(df, keys, ts, tie, kind, start, stop, fallbacks=()):
    """Pair alternating events (start, stop) of a key into numbered intervals.

    Only the first event of each run counts, a leading ``stop`` is ignored, the
    n-th start is paired with the n-th stop, and a missing stop is taken from
    the ``fallbacks`` columns (constant per key) in order.
    """
    o = ordered(df, keys, [ts, *tie]).filter(F.col(kind).isin(start, stop)).look(_pk=("lag", kind))
    o = o.filter(F.col("_pk").isNull() | (F.col("_pk") != F.col(kind)))
    o = o.filter(~(F.col("_pk").isNull() & (F.col(kind) == stop)))
    # alternating now, so the pair number is the count of starts so far
    o = o.look(pair=("sum", (F.col(kind) == start).cast("bigint")))
    pairs = o.result().groupBy(*keys, "pair").agg(
        F.min(F.when(F.col(kind) == start, F.col(ts))).alias("start_datetime"),
        F.min(F.when(F.col(kind) == stop, F.col(ts))).alias("stop_datetime"),
        *[F.max(c).alias(c) for c in fallbacks],
    )
    stop_at = F.coalesce("stop_datetime", *fallbacks)
    return pairs.select(
        *keys, "pair", "start_datetime", stop_at.alias("stop_datetime"),
        elapsed(F.col("start_datetime"), stop_at, "days").alias("duration_days"),
    )


# ------------------------------------------------------------ rolling windows

def rolling(df, keys, ts, value, hours, fn="max", name="rolling"):
    """``fn`` (``max, min, sum, count, avg``) of ``value`` over the ``hours`` up to
    and including each row's time; rows at the same time see each other, rows
    without a time see nothing.

    Where windows hold few rows this is one RANGE frame, whose cost per row is
    the number of rows in the frame.  Dense windows, and hot keys, take a road
    that is linear in the rows however dense they are, see
    :func:`_rolling_linear`; the rows per window's width tell which.
    """
    width = int(hours * 3_600_000_000)
    cuts = find_cuts(df, keys, ts)
    if cuts is None and not _dense(df, keys, ts, width):
        spec = Window.partitionBy(*keys).orderBy(F.unix_micros(ts)).rangeBetween(-width, 0)
        return df.withColumn(name, F.when(F.col(ts).isNotNull(), getattr(F, fn)(value).over(spec)))
    steps = {"max": ("max",), "min": ("min",), "sum": ("sum",), "count": ("count",), "avg": ("sum", "count")}[fn]
    out = df
    for step in steps:
        out = _rolling_linear(out, list(keys), ts, value, width, step, f"_{step}", cuts)
    if fn == "avg":
        out = out.withColumn(name, F.col("_sum") / F.nullif(F.col("_count"), F.lit(0)))
    else:
        out = out.withColumn(name, F.col(f"_{fn}"))
    return out.select(*[c for c in df.columns if c != name], name)


# A row's frame may hold this many rows on average before the linear road is cheaper.
DENSE_ROWS = "spark.wardflow.denseRows"
DEFAULT_DENSE_ROWS = 256


def _dense(df, keys, ts, width) -> bool:
    """The frames hold many rows: counted per key and block of the window's width, which bounds the work of a RANGE frame."""
    blocks = df.filter(F.col(ts).isNotNull()).groupBy(*keys, F.floor(F.unix_micros(ts) / F.lit(width))).agg(F.count("*").cast("double").alias("n"))
    found = blocks.agg(F.sum(F.col("n") * F.col("n")).alias("work"), F.sum("n").alias("rows")).first()
    return bool(found["rows"]) and found["work"] / found["rows"] > setting(df.sparkSession, DENSE_ROWS, DEFAULT_DENSE_ROWS)


def _rolling_linear(df, keys, ts, value, width, fn, name, cuts):
    """Rolling value from time blocks as wide as the window.

    A window ending at ``t`` is the end of the previous block from ``t - width``
    on, and the start of the own block up to ``t``.  Both are running values of
    a block, read by a probe that travels with its row: forward in the own
    block, backward in the previous one.
    """
    kind = "sum" if fn == "count" else fn
    at = F.unix_micros(ts)
    amount = F.when(F.col(value).isNotNull(), F.lit(1).cast("bigint")) if fn == "count" else F.col(value)

    def block(x):
        return F.floor(x / F.lit(width)).cast("bigint")

    lean = df.select(*keys, at.alias("_o"), amount.alias("_x")).filter(F.col("_x").isNotNull() & F.col("_o").isNotNull())
    probes = df.select(*keys, at.alias("_t"), F.struct(*df.columns).alias("_row"))

    def read(probes, position, own_block, side, backward, out):
        asked = probes.withColumns({"_o": position, "_block": own_block, "_side": F.lit(1 - side)})
        told = lean.withColumns({"_block": block(F.col("_o")), "_side": F.lit(side)})
        rows = asked.unionByName(told, allowMissingColumns=True)
        o = Ordered(rows, [*keys, "_block"], ["_o", "_side"], cuts, keys, backward).look(**{out: (kind, "_x")})
        return o.result().filter(F.col("_row").isNotNull()).drop("_o", "_x", "_block", "_side")

    t = F.col("_t")
    near = read(probes, t, block(t), 0, False, "_near")
    far = read(near, t - width, block(t) - 1, 1, True, "_far")
    # a window that starts on a block edge reaches back exactly to that edge
    far = far.withColumn("_v", _merge(kind, F.col("_near"), F.col("_far")))
    found = F.coalesce("_v", F.lit(0)) if fn == "count" else F.col("_v")
    return far.select("_row.*", F.when(F.col("_t").isNotNull(), found).alias(name))


def sustained(df, keys, ts, tie, value, below, hours):
    """First time per key at which the rolling maximum over ``hours`` is below
    ``below`` and at least ``hours`` of readings lie behind."""
    rolled = rolling(df, keys, ts, value, hours, "max", "rolling_max")
    o = Ordered(rolled, keys, [ts, *tie]).whole(_first=("min", ts))
    hit = o.result().filter((elapsed("_first", ts, "hours") >= hours) & (F.col("rolling_max") < below))
    return hit.groupBy(*keys).agg(
        F.min(ts).alias("sustained_datetime"), F.min(elapsed("_first", ts, "hours")).alias("hours_to_sustained")
    )


def rolling_drop(df, keys, ts, value, days=2.0, change_by=-2.0, fn="max", name="change"):
    """Rows whose value fell by at least ``-change_by`` against the ``fn`` of the
    previous ``days`` (``change_by`` > 0 looks for rises)."""
    rolled = rolling(df, keys, ts, value, days * 24, fn, "_ref").withColumn(name, F.col(value) - F.col("_ref"))
    hit = F.col(name) <= change_by if change_by < 0 else F.col(name) >= change_by
    return rolled.filter(hit).drop("_ref")


# ----------------------------------------------------------- series measures

def time_in_band(df, keys, ts, tie, value, bands, last_hours=1.0):
    """Readings, hours and percent of hours with the value in each band.

    ``bands`` maps a name to a boolean expression text, e.g. ``{"lt110": "value < 110"}``.
    """
    rows = time_to_next(df, keys, ts, tie, "hours", last_hours, "_d")
    aggs = [F.sum("_d").alias("total_hours"), F.count("*").alias("n_readings")]
    for n, text in bands.items():
        inside = F.expr(text)
        aggs += [F.count_if(inside).alias(f"{n}_num"), F.coalesce(F.sum(F.when(inside, F.col("_d"))), F.lit(0.0)).alias(f"{n}_hours")]
    out = rows.groupBy(*keys).agg(*aggs)
    return out.withColumns({f"{n}_pct": F.col(f"{n}_hours") / F.col("total_hours") * 100 for n in bands})


def auc(df, keys, ts, tie, value):
    """Trapezoid area (value x hours), its duration and the time-weighted mean."""
    o = ordered(df, keys, [ts, *tie]).look(_pv=("lag", value), _pt=("lag", ts))
    area = (F.col(value) + F.col("_pv")) / 2 * elapsed("_pt", ts, "hours")
    return (
        o.result()
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("auc"), elapsed(F.min(ts), F.max(ts), "hours").alias("duration"))
        .withColumn("wt_avg", F.col("auc") / F.nullif(F.col("duration"), F.lit(0.0)))
    )
