"""Joins by time and by membership.

Plain equi joins carry no broadcast hints: Spark broadcasts a side only when
its measured size is below the session threshold, and adaptive execution
splits hot partitions of the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import elapsed, offset
from .pick import pick_first
from .series import Ordered
from .skew import crowded_keys, has_hot_key, is_small, parted


def restrict_to(df: DataFrame, ids: DataFrame, on, keep: bool = True) -> DataFrame:
    """Rows whose key is (or is not) in ``ids``."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(ids.select(*on), on, "left_semi" if keep else "left_anti")


def left_optional(left: DataFrame, right: DataFrame, on, where: Column | None = None) -> DataFrame:
    """Left join whose extra conditions belong to the optional side."""
    return left.join(right if where is None else right.filter(where), on, "left")


def assemble(base: DataFrame, parts: list[DataFrame], on) -> DataFrame:
    """One wide row per key: ``base`` left-joined with parts that have one row per key.

    Parts built by a group-by on the same key are already partitioned by it, so
    the chain moves the base once and no part again, however many parts there
    are.  Base and parts that :func:`~wardflow.sources.write.write_bucketed`
    has stored in buckets of the key are not moved at all.
    """
    on = [on] if isinstance(on, str) else list(on)
    return reduce(lambda wide, part: wide.join(part, on, "left"), parts, base)


def merge_full(parts: list[DataFrame], on) -> DataFrame:
    """Full outer join of aggregated parts on the same key columns."""
    on = [on] if isinstance(on, str) else list(on)
    return reduce(lambda a, b: a.join(b, on, "full"), parts)


# ----------------------------------------------------------------- as-of join

@dataclass(frozen=True)
class History:
    """Dated states of a key: ``at`` orders them, ``tie`` orders those of one instant, the period says when one counts."""

    states: DataFrame
    at: str
    cols: Sequence[str]
    tie: Sequence[str] = ()
    valid_from: str | None = None
    valid_to: str | None = None


# Place of a row within one instant: period starts, events (strict), states, events, period ends.
_STARTS, _ENDS = -(2**40), 2**40


def asof_join(
    events: DataFrame, states: DataFrame, keys, ts: str, state_ts: str, cols, state_tie=(),
    strict: bool = False, valid_from: str | None = None, valid_to: str | None = None, how: str = "left",
) -> DataFrame:
    """State of each key at event time: the latest state at or before the event, see :func:`asof_histories`."""
    history = History(states, state_ts, list(cols), list(state_tie), valid_from, valid_to)
    return asof_histories(events, [history], keys, ts, strict, how)


def asof_histories(events: DataFrame, histories: Sequence[History], keys, ts: str, strict: bool = False, how: str = "left") -> DataFrame:
    """The state of several histories at event time, all in one pass over the events.

    Of each history the latest state at or before the event counts (``strict``:
    before it); one that is not valid at the event counts as none, it does not
    uncover an older one.  States with equal times are ordered by ``tie``:
    without a period the last one counts, with one the last that is valid at
    the event.  An unknown event time has no state; ``how="inner"`` keeps events
    that have a state in every history.  Column names of the histories must
    differ from each other and from those of the events.

    Events and states are unioned and the last state of every history is carried
    forward: one exchange and one sort whatever the number of histories.
    Histories with periods are first turned into steps, see :func:`_steps`; in large inputs without hot keys the rows
    of each are dealt by key once and the steps stay there.
    """
    keys = list(keys)
    kind = events.schema[ts].dataType
    timed = any(h.valid_from or h.valid_to for h in histories)
    # The given rows are counted, so that no step is made only to be counted.
    raw = [events.select(*keys), *[h.states.filter(F.col(h.at).isNotNull()).select(*keys) for h in histories]]
    calm = timed and not is_small(*raw) and not has_hot_key(reduce(DataFrame.union, raw), keys)
    event_cols = [c for c in events.columns if c not in keys]
    # Place inside one instant: any spread that the row itself decides, so that a hot instant can be cut.
    if is_small(events, *[h.states for h in histories]):
        spread = F.lit(1).cast("bigint")
    else:
        plain = [c for c in events.columns if isinstance(events.schema[c].dataType, T.AtomicType)]
        spread = F.pmod(F.xxhash64(*plain), F.lit(2**31 - 1)) + 1
    rows = events.select(*keys, F.col(ts).alias("_at"), (-spread if strict else spread).alias("_pos"), F.struct(*event_cols).alias("_event"))
    rows = rows.repartition(*keys) if calm and keys else rows
    ties, found = [], {}
    for i, history in enumerate(histories):
        fields = [f"_t{i}_{j}" for j in range(len(history.tie))]
        known = history.states.filter(F.col(history.at).isNotNull())
        if history.valid_from or history.valid_to:
            stated = (_calm_steps if calm else _steps)(known, history, keys, kind).withColumnRenamed("_step", f"_s{i}")
        else:
            state = F.struct(F.struct(*history.cols).alias("v")).alias(f"_s{i}")
            tied = [F.col(c).alias(f) for c, f in zip(history.tie, fields)]
            stated = known.select(*keys, F.col(history.at).alias("_at"), F.lit(0).cast("bigint").alias("_pos"), state, *tied)
            stated = stated.repartition(*keys) if calm and keys else stated
            ties += fields
        rows = rows.unionByName(stated, allowMissingColumns=True)
        found[f"_f{i}"] = ("last", f"_s{i}")
    filled = Ordered(rows, keys, ["_at", "_pos", *ties], None if calm else "find").look(**found).result()
    out = filled.filter(F.col("_event").isNotNull())
    out = out.withColumns({f: F.when(F.col("_at").isNotNull(), F.col(f)["v"]) for f in found})
    if how == "inner":
        out = out.filter(reduce(Column.__and__, [F.col(f).isNotNull() for f in found]))
    states = [F.col(f"_f{i}")[c].alias(c) for i, h in enumerate(histories) for c in h.cols]
    return out.select(*keys, *[F.col("_event")[c].alias(c) for c in event_cols], *states)


def _steps(known: DataFrame, history: History, keys: list[str], kind: T.DataType) -> DataFrame:
    """States with periods as steps: rows ``_at, _pos, _step`` such that the last step before an event tells its state.

    A state begins a step when it is entered or when its period starts, if that
    is later, and ends it when the period ends, if that is before the next
    instant of the key.  That is all for instants of one state.  Where several
    states of an instant have periods, the steps come from :func:`_tied_steps`.
    """
    placed = _placed(_lean(known, history, keys, kind), keys, "find")
    rows = placed.withColumn("_tied", F.coalesce((F.col("_before") == F.col("_at")) | (F.col("_after") == F.col("_at")), F.lit(False)))
    one, p, q = F.col("_state")["v"], F.col("_from"), F.col("_to")
    none, known_state = F.when(F.lit(False), one), F.col("_state").isNotNull()
    single = F.array(
        F.struct("_at", F.lit(0).cast("bigint").alias("_pos"), F.struct(F.when(p == F.col("_at"), one).alias("v")).alias("_step")),
        F.when(known_state & (p > F.col("_at")) & _until(p, "<="), F.struct(p.alias("_at"), F.lit(_STARTS).alias("_pos"), F.struct(one.alias("v")).alias("_step"))),
        F.when(known_state & _until(q, "<"), F.struct(q.alias("_at"), F.lit(_ENDS).alias("_pos"), F.struct(none.alias("v")).alias("_step"))),
    )
    plain = rows.filter("not _tied").withColumn("_each", F.explode(F.filter(single, lambda x: x.isNotNull())))
    return plain.select(*keys, "_each.*").unionByName(_tied_steps(rows.filter("_tied"), keys))


def _lean(known: DataFrame, history: History, keys: list[str], kind: T.DataType, together: bool = False) -> DataFrame:
    """Of each instant, start and end the greatest state: rows ``_at, _from, _to, _state``; ``together`` leaves a key's rows in one task."""
    at = F.col(history.at).cast(kind)
    start = F.greatest(at, F.col(history.valid_from).cast(kind)) if history.valid_from else at
    stop = F.col(history.valid_to).cast(kind) if history.valid_to else F.lit(None).cast(kind)
    valid = F.lit(True)
    if history.valid_from:
        valid = valid & F.col(history.valid_from).isNotNull()
    if history.valid_to:
        valid = valid & F.coalesce(stop >= start, F.lit(False))
    ties = [f"_t{i}" for i in range(len(history.tie))]
    state = F.struct(*[F.col(c).alias(f) for c, f in zip(history.tie, ties)], F.struct(*history.cols).alias("v"))
    lean = known.select(*keys, at.alias("_at"), start.alias("_from"), stop.alias("_to"), F.when(valid, state).alias("_state"))
    lean = lean.repartition(*keys) if together and keys else lean
    # Of states with one period only the greatest can be found.
    return lean.groupBy(*keys, "_at", "_from", "_to").agg(F.max("_state").alias("_state"))


def _placed(lean: DataFrame, keys: list[str], cuts) -> DataFrame:
    """With the times of the rows before and after, ``_before`` and ``_after``, and of the ``_next`` instant."""
    # From the end, so that all states of an instant see the next one.
    placed = Ordered(lean, keys, ["_at", "_from", "_to"], cuts, backward=True).look(_after=("lag", "_at"), _before=("lead", "_at"))
    return placed.look(_next=("last", F.when(F.col("_after") != F.col("_at"), F.col("_after")))).result()


# States of an instant that are compared with each other in one row.
_FEW = 8


def _calm_steps(known: DataFrame, history: History, keys: list[str], kind: T.DataType) -> DataFrame:
    """The steps of :func:`_steps` where no key is hot: one exchange by key.

    The few states of an instant become one row, which tells at each of its bounds the greatest state that is valid
    there; instants of more states take :func:`_tied_steps`.
    """
    here = [*keys, "_at"]
    rows = _placed(_lean(known, history, keys, kind, together=True), keys, None)
    inside = Window.partitionBy(*here).orderBy("_from", "_to")
    total = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(*here, "_from", "_to", "_state", "_next", F.row_number().over(inside).alias("_i"), F.count("*").over(total).alias("_n"))
    each = F.when(F.col("_state").isNotNull(), F.struct(F.col("_from").alias("p"), F.col("_to").alias("q"), F.col("_state").alias("o")))
    places = [F.max(F.when(F.col("_i") == i + 1, each)) for i in range(_FEW)]
    few = rows.filter(F.col("_n") <= _FEW).groupBy(*here, "_next").agg(F.array_compact(F.array(*places)).alias("_all"))

    def bound(at, side):
        return F.struct(at.alias("at"), F.lit(side).alias("side"))

    def reached(b):
        before_next = F.when(b["side"] == 1, b["at"] < F.col("_next")).otherwise(b["at"] <= F.col("_next"))
        return F.col("_next").isNull() | before_next

    def step(b):
        def holds(x):
            return (x["p"] <= b["at"]) & (x["q"].isNull() | F.when(b["side"] == 1, b["at"] < x["q"]).otherwise(b["at"] <= x["q"]))

        best = F.array_max(F.transform(F.filter("_all", holds), lambda x: x["o"]))
        place = F.when(b["side"] == 1, F.lit(_ENDS)).when(b["at"] == F.col("_at"), F.lit(0).cast("bigint")).otherwise(F.lit(_STARTS))
        return F.struct(b["at"].alias("_at"), place.alias("_pos"), F.struct(best["v"].alias("v")).alias("_step"))

    # A state is valid at its end, so nothing changes there but just behind it.
    starts = F.transform("_all", lambda x: bound(x["p"], 0))
    ends = F.transform(F.filter("_all", lambda x: x["q"].isNotNull()), lambda x: bound(x["q"], 1))
    bounds = F.array_distinct(F.concat(F.array(bound(F.col("_at"), 0)), starts, ends))
    few = few.withColumn("_bounds", F.filter(bounds, reached))
    few = few.select(*keys, F.explode(F.transform("_bounds", step)).alias("_each")).select(*keys, "_each.*")
    many = _tied_steps(rows.filter(F.col("_n") > _FEW).drop("_i", "_n"), keys, None)
    return few.unionByName(many.repartition(*keys) if keys else many)


def _until(x: Column, sign: str) -> Column:
    """``x`` is a time before (or at) the next instant of the key."""
    reached = x <= F.col("_next") if sign == "<=" else x < F.col("_next")
    return x.isNotNull() & (F.col("_next").isNull() | reached)


def _tied_steps(tied: DataFrame, keys: list[str], cuts="find") -> DataFrame:
    """Steps of instants with several states: at every period bound the greatest state valid there.

    The bounds of an instant are numbered.  A period is cut into dyadic ranges
    of numbers, of each range only its greatest state is kept, and a bound looks
    in the ranges that hold it, so m states cost m log m rows, which are keyed
    by instant and range and thus spread over tasks.
    """
    def bound(at, side, when=None):
        found = F.struct(F.col(at).alias("at"), F.lit(side).alias("side"))
        return found if when is None else F.when(when, found)

    # Sides: at the bound, and just behind it.
    valid = F.col("_state").isNotNull()
    bounds = F.array(bound("_at", 0), bound("_from", 0, valid), bound("_to", 0, valid & F.col("_to").isNotNull()), bound("_to", 1, valid & F.col("_to").isNotNull()))
    group = F.struct(*keys, F.col("_at").alias("_instant")).alias("_g")
    ends = tied.select(group, "_next", F.col("_from").alias("p"), F.col("_to").alias("q"), F.col("_state").alias("o"), F.explode(F.array_compact(bounds)).alias("_b")).select("*", "_b.*").drop("_b")
    numbered = Ordered(ends, ["_g"], ["at", "side"], cuts).look(_last=("lag", F.struct("at", "side")))
    numbered = numbered.with_columns({"_new": (~F.col("_last").eqNullSafe(F.struct("at", "side"))).cast("bigint")}).look(r=("sum", "_new")).whole(n=("max", "r"))
    rows = numbered.result()

    # Without an end a state is valid at every bound behind its start.
    ranged = rows.filter("o is not null").groupBy("_g", "n", "o", "p", "q").agg(
        F.min(F.when((F.col("at") == F.col("p")) & (F.col("side") == 0), F.col("r"))).alias("low"), F.max(F.when((F.col("at") == F.col("q")) & (F.col("side") == 0), F.col("r"))).alias("high"),
    ).withColumn("stop", F.coalesce("high", "n") + 1)
    ranged = ranged.withColumn("k", F.explode(F.sequence(F.lit(0), F.length(F.bin("stop")))))
    ranged = ranged.withColumns({"x": F.expr("shiftright(low + shiftleft(1L, k) - 1, k)"), "y": F.expr("shiftright(stop, k)")}).filter("x < y")
    pieces = F.array(F.when(F.col("x") % 2 == 1, F.col("x")), F.when(F.col("y") % 2 == 1, F.col("y") - 1))
    ranges = ranged.withColumn("i", F.explode(F.array_compact(pieces))).groupBy("_g", "k", "i").agg(F.max("o").alias("o"))

    asked = rows.groupBy("_g", "_next", "n", "at", "side").agg(F.min("r").alias("r"))
    asked = asked.filter(F.when(F.col("side") == 1, _until(F.col("at"), "<")).otherwise(_until(F.col("at"), "<=")))
    asked = asked.withColumn("k", F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("n") + 1))))).withColumn("i", F.expr("shiftright(r, k)"))
    best = asked.join(ranges, ["_g", "k", "i"], "left").groupBy("_g", "at", "side").agg(F.max("o").alias("o"))
    place = F.when(F.col("side") == 1, F.lit(_ENDS)).when(F.col("at") == F.col("_g")["_instant"], F.lit(0).cast("bigint")).otherwise(F.lit(_STARTS))
    return best.select(*[F.col("_g")[k].alias(k) for k in keys], F.col("at").alias("_at"), place.alias("_pos"), F.struct(F.col("o")["v"].alias("v")).alias("_step"))


def asof_tied(events: DataFrame, states: DataFrame, keys, ts: str, state_ts: str, cols, valid_from: str, valid_to: str, strict: bool = False) -> DataFrame:
    """Events with every state of the latest instant that is valid at the event, one row per state.

    The instant is carried to the event in one pass; its states are then met by
    key, instant and period, see :func:`interval_join`.
    """
    keys = list(keys)
    known = states.filter(F.col(state_ts).isNotNull())
    instants = known.select(*keys, F.col(state_ts).alias("_state_at"), F.col(state_ts).alias("_instant"))
    found = asof_histories(events, [History(instants, "_state_at", ["_instant"])], keys, ts, strict, "inner")
    spans = known.select(*keys, F.col(state_ts).alias("_instant"), F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *[F.col(c).alias(f"_c_{c}") for c in cols])
    if not is_small(events, states) and crowded_keys(events, known, keys) == []:
        # Nor can an instant of a key be crowded.
        met = _met(found, spans.filter(F.col("_from") <= F.col("_to")), [*keys, "_instant"], ts, "_from", "_to")
    else:
        met = interval_join(found, spans, [*keys, "_instant"], ts, "_from", "_to")
    return met.select(*events.columns, *[F.col(f"_c_{c}").alias(c) for c in cols])


def first_state(states: DataFrame, keys, order, label: str, skip=(), targets=None) -> DataFrame:
    """First state of each key outside ``skip``; only keys whose first state is in ``targets``."""
    rows = states.filter(~F.col(label).isin(list(skip))) if skip else states
    first = pick_first(rows, keys, order)
    return first.filter(F.col(label).isin(list(targets))) if targets else first


# -------------------------------------------------------------- interval joins

# Bin widths; a span uses the first width that covers it in at most 9 bins.
_WIDTHS_S = (60, 3_600, 86_400, 86_400 * 30, 86_400 * 730, 86_400 * 18_250)


def _level(start: Column, stop: Column) -> Column:
    length = F.unix_micros(stop) - F.unix_micros(start)
    out = None
    for level, seconds in enumerate(_WIDTHS_S[:-1]):
        out = (F if out is None else out).when(length <= 8 * seconds * 1_000_000, F.lit(level))
    return out.otherwise(F.lit(len(_WIDTHS_S) - 1))


def _bin_number(ts: Column, level: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(_WIDTHS_S[level] * 1_000_000)).cast("bigint")


def _span_bins(start: Column, stop: Column, levels) -> Column:
    """(level, bin) of every bin a span touches at its own level."""
    out = None
    for level in levels:
        numbers = F.sequence(_bin_number(start, level), _bin_number(stop, level))
        bins = F.transform(numbers, partial(_bin, level))
        out = (F if out is None else out).when(_level(start, stop) == level, bins)
    return out


def _point_bins(ts: Column, levels) -> Column:
    return F.array(*[_bin(level, _bin_number(ts, level)) for level in levels])


def _bin(level: int, number: Column) -> Column:
    return F.struct(F.lit(level).alias("l"), number.alias("b"))


def interval_join(points: DataFrame, spans: DataFrame, keys, ts: str, start: str, stop: str,
                  closed: str = "both", how: str = "inner") -> DataFrame:
    """Points joined with the spans of the same key that contain them.

    ``closed``: ``both``, ``left`` (stop excluded), ``right`` (start excluded) or
    ``neither``.  Column names of the two sides must differ apart from ``keys``;
    spans with an unknown bound contain nothing.  Rows are joined on the key
    alone, those of crowded keys (see :func:`~wardflow.operators.skew.crowded_keys`)
    on the key and a time bin, so that a point only meets spans near it and the
    key is spread over its bins; bins come in several widths, a span uses the one
    that suits its length, and points look in the widths that occur.
    """
    keys = list(keys)
    spans = spans.filter(F.col(start) <= F.col(stop))
    args = keys, ts, start, stop, closed, how
    crowded = [] if is_small(points, spans) else crowded_keys(points, spans, keys) if keys else None
    if crowded == []:
        return _met(points, spans, *args)
    if crowded is None:
        return _met_in_bins(points, spans, *args)
    (cold, hot), (cold_spans, hot_spans) = parted(points, keys, crowded), parted(spans, keys, crowded)
    return _met(cold, cold_spans, *args).unionByName(_met_in_bins(hot, hot_spans, *args))


def _inside_span(ts, start, stop, closed) -> Column:
    inside = (F.col(ts) > F.col(start)) if closed in ("right", "neither") else (F.col(ts) >= F.col(start))
    return inside & ((F.col(ts) < F.col(stop)) if closed in ("left", "neither") else (F.col(ts) <= F.col(stop)))


def _met(points, spans, keys, ts, start, stop, closed="both", how="inner"):
    return _match(points, spans, keys, ts, start, stop, _inside_span(ts, start, stop, closed), None, how)


def _met_in_bins(points, spans, keys, ts, start, stop, closed="both", how="inner"):
    inside = _inside_span(ts, start, stop, closed)
    # at most one row per width
    used = spans.select(_level(F.col(start), F.col(stop)).alias("level")).distinct().collect()
    levels = sorted(r["level"] for r in used) or [0]
    if how == "left":
        return _match_left(points, spans, keys, ts, start, stop, closed, inside, levels)
    return _match(points, spans, keys, ts, start, stop, inside, levels, how)


def _match(points, spans, keys, ts, start, stop, inside, levels, how="inner"):
    right_keys = [f"_k_{k}" for k in keys]
    on = [F.col(r) == F.col(k) for r, k in zip(right_keys, keys)]
    left, right = points, spans.withColumnsRenamed(dict(zip(keys, right_keys)))
    if levels is not None:
        left = left.withColumn("_bin", F.explode(_point_bins(F.col(ts), levels)))
        right = right.withColumn("_sbin", F.explode(_span_bins(F.col(start), F.col(stop), levels)))
        on.append(F.col("_bin") == F.col("_sbin"))
    return left.join(right, reduce(lambda a, b: a & b, on) & inside, how).drop(*right_keys, "_bin", "_sbin")


def _match_left(points, spans, keys, ts, start, stop, closed, inside, levels):
    """Left form with bins: the matches, and the points that no span covers."""
    found = _match(points, spans, keys, ts, start, stop, inside, levels)
    alone = _uncovered(points, spans, keys, ts, start, stop, closed)
    return found.unionByName(alone, allowMissingColumns=True).select(*points.columns, *[c for c in spans.columns if c not in keys])


def _uncovered(points, spans, keys, ts, start, stop, closed):
    """Points that lie in no span of their key: begun less ended spans are counted along time, in one pass."""
    kind = points.schema[ts].dataType
    known = spans.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys], F.lit(True)))
    if closed != "both":  # such a span holds no point
        known = known.filter(F.col(start) < F.col(stop))
    begins, ends = (-1 if closed in ("both", "left") else 1), (1 if closed in ("both", "right") else -1)
    rows = points.select(*keys, F.col(ts).alias("_at"), F.lit(0).alias("_pos"), F.struct(*points.columns).alias("_point"))
    for at, pos, step in ((start, begins, 1), (stop, ends, -1)):
        told = known.select(*keys, F.col(at).cast(kind).alias("_at"), F.lit(pos).alias("_pos"), F.lit(step).cast("bigint").alias("_change"))
        rows = rows.unionByName(told, allowMissingColumns=True)
    out = Ordered(rows, keys, ["_at", "_pos"]).look(_open=("sum", "_change")).result()
    free = F.col("_at").isNull() | (F.coalesce("_open", F.lit(0)) == 0)
    return out.filter(F.col("_point").isNotNull() & free).select("_point.*")


def overlap_join(a: DataFrame, b: DataFrame, keys, a_start, a_stop, b_start, b_stop) -> DataFrame:
    """Pairs of spans of the same key that share at least one instant; those of crowded keys meet in bins, as in :func:`interval_join`."""
    keys = list(keys)
    a = a.filter(F.col(a_start) <= F.col(a_stop))
    b = b.filter(F.col(b_start) <= F.col(b_stop))
    bounds = a_start, a_stop, b_start, b_stop
    crowded = [] if is_small(a, b) else crowded_keys(a, b, keys) if keys else None
    if crowded == []:
        return _overlaps(a, b, keys, *bounds)
    if crowded is None:
        return _overlaps_in_bins(a, b, keys, *bounds)
    (cold_a, hot_a), (cold_b, hot_b) = parted(a, keys, crowded), parted(b, keys, crowded)
    return _overlaps(cold_a, cold_b, keys, *bounds).unionByName(_overlaps_in_bins(hot_a, hot_b, keys, *bounds))


def _overlaps(a, b, keys, a_start, a_stop, b_start, b_stop):
    right = b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    cond = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    cond = cond & (F.col(a_start) <= F.col(b_stop)) & (F.col(b_start) <= F.col(a_stop))
    return a.join(right, cond).drop(*[f"_k_{k}" for k in keys])


def _overlaps_in_bins(a, b, keys, a_start, a_stop, b_start, b_stop):
    # b starts inside a, or a starts inside b but after it: disjoint cases.
    one = _met_in_bins(b, a, keys, b_start, a_start, a_stop)
    two = _met_in_bins(a, b, keys, a_start, b_start, b_stop, closed="right")
    cols = [*a.columns, *[c for c in b.columns if c not in keys]]
    return one.select(*cols).unionByName(two.select(*cols))


def look_forward(df: DataFrame, person: str, at: str, end: str, days: float, cols, prefix: str = "next_") -> DataFrame:
    """Later encounters of the same person that start within ``days`` after ``end``."""
    later = df.select(person, *[F.col(c).alias(f"{prefix}{c}") for c in dict.fromkeys([at, *cols])])
    spans = df.withColumns({"_from": F.col(end), "_to": offset(end, days, "days")})
    out = interval_join(later, spans, [person], f"{prefix}{at}", "_from", "_to", closed="right")
    return out.select(*df.columns, *[f"{prefix}{c}" for c in dict.fromkeys([at, *cols])])


def look_back(df: DataFrame, person: str, at: str, end: str, days: float, cols, id_col: str, prefix: str = "prior_") -> DataFrame:
    """Earlier encounters of the same person that ended within ``days`` before ``at``."""
    names = list(dict.fromkeys([id_col, end, *cols]))
    earlier = df.select(person, *[F.col(c).alias(f"{prefix}{c}") for c in names])
    spans = df.withColumns({"_from": offset(at, -days, "days"), "_to": F.col(at)})
    out = interval_join(earlier, spans, [person], f"{prefix}{end}", "_from", "_to")
    out = out.filter(F.col(f"{prefix}{id_col}") != F.col(id_col))
    return out.select(*df.columns, *[f"{prefix}{c}" for c in names])


# ------------------------------------------------------------------ code tables

def decode_codes(df: DataFrame, codes: DataFrame, code: str, display: str, columns: dict[str, str]) -> DataFrame:
    """Replace code columns by their display text: ``{code column: new name}``."""
    dim = codes.select(F.col(code).alias("_code"), F.col(display).alias("_display"))
    for source, name in columns.items():
        df = df.join(dim.withColumnsRenamed({"_code": f"_c_{name}", "_display": name}), F.col(source) == F.col(f"_c_{name}"), "left")
        df = df.drop(f"_c_{name}")
    return df


def reconcile(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Key status of two populations: ``both``, ``left_only`` or ``right_only``."""
    keys = list(keys)
    a = left.select(*keys).withColumn("_side", F.lit(1))
    b = right.select(*keys).withColumn("_side", F.lit(2))
    seen = a.union(b).groupBy(*keys).agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))
    status = F.when(F.col("_lo") != F.col("_hi"), "both").when(F.col("_lo") == 1, "left_only").otherwise("right_only")
    return seen.select(*keys, status.alias("status"))


def prior_encounters(df: DataFrame, person: str, start: str, end: str, tie) -> DataFrame:
    """Each encounter with its nearest predecessor's end and the days between."""
    o = Ordered(df, [person], [start, *tie]).look(prior_end=("lag", end))
    return o.result().withColumn("days_since_prior", elapsed("prior_end", start, "days"))
