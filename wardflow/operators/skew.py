"""Cutting hot keys into ordered chunks.

A window partitioned by an encounter id puts all rows of one id in one task.
That is fine until an id (or a NULL id, or a catch-all id) holds a large share
of the table.  The operators of this library therefore ask for :func:`find_cuts`
before they order rows by key: hot keys get cut points along the ordering
column, every row gets a chunk number, and the work is partitioned by
(key, chunk).  Cold keys keep the single chunk 0.

The cut points are plain driver-side values, at most ``MAX_CHUNKS`` of them in
total whatever the table size, so sending them to every task is always safe,
and a task that is run again after an executor loss sees the same chunks.
Large tables are sampled to choose them; that only decides where a key is cut,
every row is worked on whatever the sample held.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot above twice this many rows; a chunk aims at this many.
CHUNK_ROWS = "spark.wardflow.chunkRows"
DEFAULT_CHUNK_ROWS = 2_000_000
# Plans that read less than this are not probed: one task can hold any key.
PROBE_BYTES = "spark.wardflow.probeBytes"
DEFAULT_PROBE_BYTES = 256 * 1024 * 1024
# Upper bound on all chunks of a table together.
MAX_CHUNKS = 20_000
# Inputs up to this size are counted in full, larger ones in proportion.
COUNTED_BYTES = 8 * 1024**3
# Rows of a key that a row may meet in a join, on average, before the key is dealt to bins.
MEET_ROWS = 1_000
# Rows looked at to place one cut point.
PLACED_ROWS = 200
# Answers of probes kept for a session, the oldest go first; one holds at most MAX_CHUNKS values.
KEPT_PROBES = 64


def setting(spark, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def is_small(*frames: DataFrame) -> bool:
    """The inputs of these plans together are too small for any key to be hot."""
    sizes = [scanned_bytes(df) for df in frames]
    limit = setting(frames[0].sparkSession, PROBE_BYTES, DEFAULT_PROBE_BYTES)
    return all(size is not None for size in sizes) and sum(sizes) < limit


# Spark reports this much or more for inputs it knows nothing about.
_UNKNOWN_BYTES = 2**60


def scanned_bytes(df: DataFrame) -> int | None:
    """Size of the inputs a plan reads, or None where it is not known.

    The inputs are measured files; the estimate above a join would be a guess.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    except Exception:  # e.g. a Connect session
        return None
    return None if any(s >= _UNKNOWN_BYTES for s in sizes) else sum(sizes)


def order_number(df: DataFrame, name: str) -> Column:
    """An ordering column as a number, or a text, that sorts the same way."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), "UTC"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.DecimalType, T.BooleanType)):
        # neighbours that share a number share a chunk
        return c.cast("double")
    if isinstance(kind, T.NumericType):
        return c
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, T.DayTimeIntervalType):
        return F.unix_micros(F.timestamp_micros(F.lit(0).cast("bigint")) + c)
    if isinstance(kind, T.YearMonthIntervalType):
        return F.extract(F.lit("YEAR"), c) * 12 + F.extract(F.lit("MONTH"), c)
    raise TypeError(f"{name}: hot keys can only be cut along a time, a number or a text, not {kind.simpleString()}")


class Cuts:
    """Cut points of the hot keys of one table, usable on any table with the same key.

    ``points`` maps a key hash to sorted ``(value, tie)`` pairs; the tie is only
    given where one value had to be cut again.
    """

    def __init__(self, spark, points: dict[int, list[tuple]]):
        self.spark = spark
        self.points = points
        self.paired = any(b is not None for cuts in points.values() for _, b in cuts)

    def table(self) -> DataFrame:
        """One row per hot key: its cut points, grouped for a two-step lookup."""
        kinds = [self._kind(i) for i in (0, 1)]
        rows = []
        for h, cuts in self.points.items():
            cuts = [tuple(float(v) if v is not None and k == "double" else v for v, k in zip(p, kinds)) for p in cuts]
            if not self.paired:
                cuts = [a for a, _ in cuts]
            step = max(1, math.isqrt(len(cuts)))
            groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
            rows.append((h, step, [g[0] for g in groups], groups))
        point = f"struct<a:{kinds[0]},b:{kinds[1]}>" if self.paired else kinds[0]
        return self.spark.createDataFrame(
            rows, f"_h bigint, _step int, _heads array<{point}>, _groups array<array<{point}>>"
        )

    def _kind(self, part: int) -> str:
        values = [p[part] for cuts in self.points.values() for p in cuts if p[part] is not None]
        return "string" if any(isinstance(v, str) for v in values) else "double" if any(isinstance(v, float) for v in values) else "bigint"

    def mark(self, df: DataFrame, keys: list[str], at: Column, tie: Column | None = None) -> DataFrame:
        """Add ``_h`` (key hash), ``_hot`` and ``_chunk``, the latter monotone in the order within a key."""
        tie = F.lit(None).cast(self._kind(1)) if tie is None else tie

        def reached(point):
            if not self.paired:
                return point <= at
            # lexicographic; a point without a second part is reached by the whole value
            return (point["a"] < at) | ((point["a"] == at) & (point["b"].isNull() | (point["b"] <= tie)))

        look = df.withColumn("_h", key_hash(keys)).join(F.broadcast(self.table()), "_h", "left")
        # one step per column, so that each part is evaluated once
        look = look.withColumns({
            "_hot": F.col("_step").isNotNull(),
            "_outer": F.when(F.col("_step").isNotNull() & at.isNotNull(), F.size(F.filter("_heads", reached))),
        })
        inner = F.size(F.filter(F.get("_groups", F.col("_outer") - 1), reached))
        chunk = F.when(F.col("_outer") > 0, (F.col("_outer") - 1) * F.col("_step") + inner).otherwise(F.lit(0))
        return look.withColumn("_chunk", chunk).drop("_step", "_heads", "_groups", "_outer")


def key_hash(keys: list[str]) -> Column:
    # A collision only cuts a cold key into chunks too: wasteful, never wrong.
    return F.xxhash64(*keys) if keys else F.lit(0).cast("long")


# Per session: (hash of the plan, question) -> (plan, answer).
_ANSWERS: WeakKeyDictionary[SparkSession, OrderedDict] = WeakKeyDictionary()


def _once(rows: DataFrame, question: tuple, find):
    """``find()``, or its answer to the same question about the same rows earlier in the session.

    Whether rows are the same is Catalyst's decision on the pruned plans: the
    window columns that an operator added are gone there, so operators in a
    chain, and reports on one table, share a probe.  A table written anew under
    its path has another size; where it has not, an old answer may cut a key
    at less even places, and every row is worked on all the same.
    """
    try:
        plan = rows._jdf.queryExecution().optimizedPlan()
        key = (plan.semanticHash(), scanned_bytes(rows), *question)
    except Exception:  # e.g. a Connect session
        return find()
    kept = _ANSWERS.setdefault(rows.sparkSession, OrderedDict())
    if key in kept and kept[key][0].sameResult(plan):
        kept.move_to_end(key)
        return kept[key][1]
    answer = find()
    kept[key] = (plan, answer)
    while len(kept) > KEPT_PROBES:
        kept.popitem(last=False)
    return answer


def has_hot_key(df: DataFrame, keys: list[str]) -> bool:
    """Some key of ``df`` has more rows than one task should order; asked once per session and rows."""
    return not is_small(df) and bool(_found_hot(df.select(key_hash(keys).alias("h")), *_question(df))[0])


def _question(df: DataFrame) -> tuple[float, tuple]:
    """The share of the rows that is counted, and what an answer depends on."""
    size = scanned_bytes(df)
    share = min(1.0, COUNTED_BYTES / size) if size else 1.0
    return share, (share, setting(df.sparkSession, CHUNK_ROWS, DEFAULT_CHUNK_ROWS), MAX_CHUNKS, PLACED_ROWS)


def _found_hot(only_keys: DataFrame, share: float, question: tuple) -> tuple[dict[int, int], float]:
    return _once(only_keys, ("hot", *question), lambda: _hot_keys(only_keys, share))


def crowded_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> list[int] | None:
    """Hashes of the keys whose rows of both sides are too many to meet on the key alone; None when they are too many to list.

    A row may meet ``MEET_ROWS`` rows of its key on average, and a key have as many rows as one that is not hot.
    """
    chunk = setting(left.sparkSession, CHUNK_ROWS, DEFAULT_CHUNK_ROWS)
    most = min(MEET_ROWS, chunk)
    known = [df.filter(" and ".join(f"`{k}` is not null" for k in keys) or "true") for df in (left, right)]
    sides = [df.select(key_hash(keys).alias("h"), F.lit(1 - i).alias("a"), F.lit(i).alias("b")) for i, df in enumerate(known)]
    rows = sides[0].unionByName(sides[1])

    def find():
        per_key = rows.groupBy("h").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
        both = F.col("a") + F.col("b")
        crowded = per_key.filter((F.col("a") > 0) & (F.col("b") > 0) & ((F.col("a") * F.col("b") > most * both) | (both > 2 * chunk)))
        found = [r["h"] for r in crowded.select("h").limit(MAX_CHUNKS // 2 + 1).collect()]
        return None if len(found) > MAX_CHUNKS // 2 else found

    return _once(rows, ("crowded", most, chunk, MAX_CHUNKS), find)


def parted(df: DataFrame, keys: list[str], hashes: list[int]) -> tuple[DataFrame, DataFrame]:
    """The rows of the other keys, and those of the keys with these hashes (at most ``MAX_CHUNKS / 2``, which are broadcast)."""
    listed = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hashes], "_listed bigint"))
    on = key_hash(keys) == F.col("_listed")
    return df.join(listed, on, "left_anti"), df.join(listed, on, "left_semi")


def find_cuts(df: DataFrame, keys: list[str], at: str, tie: str | None = None) -> Cuts | None:
    """Cut points for the hot keys of ``df``, or None when no key is hot.

    The first pass counts rows per key, of a sample when the inputs are large:
    a key above the limit has thousands of sampled rows there, so it is seen.
    Only when there are hot keys does a second pass take quantiles of the
    ordering column of those keys.  Both are asked once per session and rows.
    """
    spark = df.sparkSession
    if is_small(df):
        return None
    at_number = order_number(df, at)
    tie_number = order_number(df, tie) if tie else F.lit(None).cast("bigint")
    lean = df.select(key_hash(keys).alias("h"), at_number.alias("a"), tie_number.alias("b"))
    share, question = _question(df)
    hot, target = _found_hot(lean.select("h"), share, question)
    if not hot:
        return None
    cuts = _once(lean, ("cuts", bool(tie), *question), lambda: _cut_points(lean, share, hot, target, tie))
    return Cuts(spark, cuts) if cuts else None


def _hot_keys(only_keys: DataFrame, share: float) -> tuple[dict[int, int], float]:
    """Hashes of the hot keys with their rows, and the rows of a chunk, both counted in the sample."""
    spark = only_keys.sparkSession
    rows = only_keys.sample(share, seed=17) if share < 1.0 else only_keys
    per_key = rows.groupBy("h").agg(F.count("*").alias("c"))
    heaviest = per_key.orderBy(F.desc("c")).limit(MAX_CHUNKS // 2).withColumn("is_total", F.lit(False))
    total = per_key.agg(F.sum("c").alias("c")).select(F.lit(None).cast("bigint").alias("h"), "c", F.lit(True).alias("is_total"))
    # both halves read the same exchange
    found = heaviest.unionByName(total).collect()
    n = next(r["c"] for r in found if r["is_total"]) or 0
    target = max(setting(spark, CHUNK_ROWS, DEFAULT_CHUNK_ROWS) * share, n / MAX_CHUNKS, 1)
    return {r["h"]: r["c"] for r in found if not r["is_total"] and r["c"] > 2 * target}, target


def _cut_points(lean: DataFrame, share: float, hot: dict[int, int], target: float, tie: str | None) -> dict[int, list[tuple]]:
    """Sorted ``(value, tie)`` pairs per hot key."""
    spark = lean.sparkSession
    lean = lean.sample(share, seed=17) if share < 1.0 else lean
    points = _quantile_points(spark, lean.select("h", "a"), hot, target)
    cuts = {h: sorted({(a, None) for a in values}, key=lambda p: _sorted_as(p[0])) for h, values in points.items()}
    if tie:
        # One instant that fills several chunks is cut again along the tie-break column.
        crowded = {(h, a): values.count(a) for h, values in points.items() for a in set(values) if values.count(a) > 1}
        if crowded:
            kind = lean.schema["a"].dataType.simpleString()
            places = spark.createDataFrame([(h, a) for h, a in crowded], f"h bigint, a {kind}")
            named = {(r["h"], r["a"]): r["x"] for r in places.select("h", "a", F.xxhash64("h", "a").alias("x")).collect()}
            by_hash = {x: pair for pair, x in named.items()}
            ties = lean.select(F.xxhash64("h", "a").alias("h"), F.col("b").alias("a"))
            want = {x: crowded[pair] * target for x, pair in by_hash.items()}
            for x, values in _quantile_points(spark, ties, want, target).items():
                h, a = by_hash[x]
                cuts[h] = cuts[h] + [(a, b) for b in set(values) if b is not None]
            for h in cuts:
                cuts[h] = sorted(set(cuts[h]), key=lambda p: (_sorted_as(p[0]), p[1] is not None, p[1] is not None and _sorted_as(p[1])))
    return {h: c for h, c in cuts.items() if c}


def _sorted_as(value):
    """Texts are ordered by their bytes, as Spark orders them."""
    return value.encode() if isinstance(value, str) else value


def _quantile_points(spark, rows: DataFrame, hot: dict[int, float], target: float) -> dict[int, list]:
    """Every ``target``-th value of ``a`` (approximately) for each hot ``h``."""
    if isinstance(rows.schema["a"].dataType, T.StringType):
        return _text_points(spark, rows, hot, target)
    most = min(MAX_CHUNKS, max(2, math.ceil(max(hot.values()) / target)))
    shares = [i / most for i in range(1, most)]
    keys = spark.createDataFrame([(h, max(1, round(most * target / n))) for h, n in hot.items()], "h bigint, every int")
    placed = rows.join(F.broadcast(keys), "h")
    if target > PLACED_ROWS:
        placed = placed.sample(PLACED_ROWS / target, seed=19)
    picked = (
        placed.groupBy("h", "every")
        .agg(F.percentile_approx("a", shares, 20 * most).alias("q"))
        .select("h", F.filter("q", lambda x, i: i % F.col("every") == 0).alias("q"))
    )
    # at most MAX_CHUNKS values, see the module comment
    return {row["h"]: [v for v in row["q"] or [] if v is not None] for row in picked.collect()}


# Cut points between texts are cut to the first of these lengths that tells them apart from the text before.
_TEXT_LENGTHS = (16, 64, 256, 1024)


def _text_points(spark, rows: DataFrame, hot: dict[int, float], target: float) -> dict[int, list]:
    """As :func:`_quantile_points` for texts: every n-th of the sampled texts themselves, in their own order.

    A hot key has at most ``MAX_CHUNKS * PLACED_ROWS`` sampled texts, which one task sorts.
    """
    parts = spark.createDataFrame([(h, max(2, min(MAX_CHUNKS, math.ceil(n / target)))) for h, n in hot.items()], "h bigint, parts int")
    placed = rows.filter(F.col("a").isNotNull()).join(F.broadcast(parts), "h")
    if target > PLACED_ROWS:
        placed = placed.sample(PLACED_ROWS / target, seed=19)
    order = Window.partitionBy("h").orderBy("a")
    ranked = placed.withColumns({"i": F.row_number().over(order), "n": F.count("*").over(Window.partitionBy("h")), "before": F.lag("a").over(order)})
    place = F.floor((F.col("i") - 1) * F.col("parts") / F.col("n"))
    picked = ranked.filter((F.col("i") > 1) & (place != F.floor((F.col("i") - 2) * F.col("parts") / F.col("n"))))
    heads = [F.when(F.left("a", F.lit(n)) > F.col("before"), F.left("a", F.lit(n))) for n in _TEXT_LENGTHS]
    points: dict[int, list] = {}
    for row in picked.select("h", F.coalesce(*heads, "a").alias("a")).collect():
        points.setdefault(row["h"], []).append(row["a"])
    return {h: sorted(values, key=str.encode) for h, values in points.items()}
