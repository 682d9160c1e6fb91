"""The hot-key road gives the same rows as plain windows and joins."""

import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import agg, courses, joins, series, skew
from wardflow.operators.series import Ordered


@pytest.fixture(scope="module")
def events(spark):
    """One key holds more than a third of the rows, many of them at one instant; one key is NULL."""
    rnd = random.Random(5)
    data = []
    for i in range(240):
        key = 1 if i % 5 < 2 else None if i % 5 == 2 else rnd.randint(2, 6)
        at = 1_700_000_000 + (3600 if i % 3 == 0 else rnd.randint(0, 50) * 900)
        value = None if rnd.random() < 0.1 else float(rnd.randint(0, 40))
        data.append((i, key, at, value, rnd.choice("abc")))
    df = spark.createDataFrame(data, "id bigint, k bigint, at bigint, v double, kind string")
    return df.withColumn("ts", F.timestamp_seconds("at")).drop("at").coalesce(3).cache()


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """Tiny data and many plans: compiling them would take most of the time."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def both(spark, build):
    spark.conf.set("spark.wardflow.probeBytes", str(2**40))
    plain = build()
    expected = sorted(map(str, plain.collect()))
    spark.conf.set("spark.wardflow.probeBytes", "0")
    spark.conf.set("spark.wardflow.chunkRows", "8")
    try:
        cut = build()
        assert sorted(map(str, cut.select(*plain.columns).collect())) == expected
    finally:
        spark.conf.unset("spark.wardflow.probeBytes")
        spark.conf.unset("spark.wardflow.chunkRows")


def test_cuts_are_found_for_hot_keys_only(spark, events, split):
    cuts = skew.find_cuts(events, ["k"], "ts", "id")
    assert cuts is not None
    marked = Ordered(events, ["k"], ["ts", "id"]).df
    chunks = {r["k"]: r["n"] for r in marked.groupBy("k").agg(F.count_distinct("_chunk").alias("n")).collect()}
    assert chunks[1] > 5 and chunks[None] > 2
    largest = marked.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 40  # the hottest key has 96 rows, 32 of them at one instant


def test_chunks_follow_the_order(spark, events, split):
    marked = Ordered(events, ["k"], ["ts", "id"]).df
    spans = marked.groupBy("k", "_chunk").agg(F.min(F.struct("ts", "id")).alias("lo"), F.max(F.struct("ts", "id")).alias("hi"))
    pairs = spans.alias("a").join(spans.alias("b"), F.expr("a.k <=> b.k and a._chunk < b._chunk"))
    assert pairs.filter("a.hi >= b.lo").count() == 0


def test_small_inputs_are_not_probed(spark, events):
    assert skew.find_cuts(events, ["k"], "ts") is None


def test_a_sample_only_moves_the_cuts(spark, monkeypatch):
    path = "/root/testdata/sf0.001/events.parquet"
    df = spark.read.parquet(path).select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 3).alias("k"), "value")
    monkeypatch.setattr(skew, "COUNTED_BYTES", skew.scanned_bytes(df) // 3)
    both(spark, lambda: Ordered(df, ["k"], ["ts", "event_id"]).look(a=("lag", "value"), b=("sum", "event_id")).result())


def test_unknown_input_size_is_counted_in_full(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert skew.scanned_bytes(df) is None and not skew.is_small(df)
    assert skew.find_cuts(df, ["k"], "v") is None


def test_look(spark, events):
    both(spark, lambda: Ordered(events, ["k"], ["ts", "id"]).look(
        a=("lag", "v"), b=("lead", "v"), c=("sum", "v"), d=("max", "v"), e=("last", "v"), f=("min", "id")).result())


def test_look_backward(spark, events):
    both(spark, lambda: Ordered(events, ["k"], ["ts", "id"], backward=True).look(
        a=("lag", "v"), b=("lead", "v"), c=("sum", "v"), d=("max", "v"), e=("last", "v")).result())


def test_whole(spark, events):
    both(spark, lambda: Ordered(events, ["k"], ["ts", "id"]).whole(
        a=("first", "v"), b=("last", "v"), c=("sum", "v"), d=("count", "v"), e=("max", "ts")).result())


@pytest.mark.parametrize("fn,hours", [("max", 0.25), ("max", 2), ("min", 2), ("sum", 48), ("count", 0.25), ("avg", 2)])
def test_rolling(spark, events, fn, hours):
    both(spark, lambda: series.rolling(events, ["k"], "ts", "v", hours, fn, "r"))


def test_islands_sessions_pairs(spark, events):
    both(spark, lambda: series.islands(events, ["k"], ["ts", "id"], "kind"))
    timed = events.withColumn("stop", F.col("ts") + F.expr("interval 10 minutes"))
    both(spark, lambda: series.sessions(timed, ["k"], "ts", "stop", ["id"], 1))
    both(spark, lambda: series.pair_events(events, ["k"], "ts", ["id"], "kind", "a", "b"))


def test_courses(spark, events):
    both(spark, lambda: courses.med_runtime(events, ["k", "kind"], "ts", "v", ["id"], 2))
    both(spark, lambda: courses.drip_runtime(events, ["k"], "ts", "v", ["id"], 1))
    both(spark, lambda: courses.series_summary(events, ["k"], "ts", "v", ["id"]))


@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles(spark, events, keys):
    both(spark, lambda: agg.exact_quantiles(events, keys, "v", (0, 0.1, 0.25, 0.5, 0.9, 1), tuple("abcdef")))
    both(spark, lambda: agg.summary_stats(events.filter("v is not null"), keys, "v").drop("mean", "sd"))


@pytest.mark.parametrize("by", [["k"], []])
def test_rank_sum(spark, events, by):
    both(spark, lambda: agg.rank_sum(events, "kind", "a", "b", "v", by))


@pytest.mark.parametrize("strict", [False, True])
def test_asof(spark, events, strict):
    states = events.filter("kind = 'a'").select("k", F.col("ts").alias("sts"), F.col("id").alias("sid"), F.col("v").alias("sv"))
    probes = events.filter("kind <> 'a'").drop("v")
    both(spark, lambda: joins.asof_join(probes, states, ["k"], "ts", "sts", ["sid", "sv"], ["sid"], strict=strict))


@pytest.mark.parametrize("how,closed", [("inner", "both"), ("inner", "left"), ("left", "right"), ("left", "neither")])
def test_interval_join(spark, events, how, closed):
    spans = events.filter("kind = 'b'").select("k", F.col("id").alias("sid"), F.col("ts").alias("beg"), (F.col("ts") + F.expr("make_interval(0,0,0,id % 30, id % 7)")).alias("end"))
    both(spark, lambda: joins.interval_join(events, spans, ["k"], "ts", "beg", "end", closed, how))


def test_overlap_join(spark, events):
    def spans(kind, p):
        return events.filter(F.col("kind") == kind).select(
            "k", F.col("id").alias(f"{p}id"), F.col("ts").alias(f"{p}beg"), (F.col("ts") + F.expr("make_interval(0,0,0,id % 3, id % 7)")).alias(f"{p}end"))

    both(spark, lambda: joins.overlap_join(spans("a", "a"), spans("b", "b"), ["k"], "abeg", "aend", "bbeg", "bend"))


def test_look_around_encounters(spark, events):
    enc = events.select("k", "id", F.col("ts").alias("start"), (F.col("ts") + F.expr("interval 1 hour")).alias("end"))
    both(spark, lambda: joins.look_forward(enc, "k", "start", "end", 0.2, ["id"]))
    both(spark, lambda: joins.look_back(enc, "k", "start", "end", 0.2, [], "id"))


@pytest.fixture
def probes(spark, monkeypatch):
    """What the probes looked for, in the order they ran."""
    asked = []
    for name in ("_hot_keys", "_cut_points"):
        def counted(*args, _name=name, _run=getattr(skew, name)):
            asked.append(_name)
            return _run(*args)

        monkeypatch.setattr(skew, name, counted)
    skew._ANSWERS.clear()
    yield asked
    skew._ANSWERS.clear()


@pytest.mark.parametrize("name", ["unit_stays", "paired_events", "series_day_summary"])
def test_a_chain_of_operators_looks_for_hot_keys_once(spark, probes, monkeypatch, name):
    from wardflow.plans import run

    spark.conf.set("spark.wardflow.probeBytes", "0")
    try:
        run(name, spark, "/root/testdata/sf0.001")
        assert probes == ["_hot_keys"]
        if name == "series_day_summary":
            return  # the median of hot keys needs cut points along the value
        spark.conf.set("spark.wardflow.chunkRows", "4")
        run(name, spark, "/root/testdata/sf0.001")
        assert probes[1:] == ["_hot_keys", "_cut_points"]
    finally:
        spark.conf.unset("spark.wardflow.probeBytes")
        spark.conf.unset("spark.wardflow.chunkRows")


def test_probes_are_shared_between_operators_on_the_same_rows(spark, events, probes, split):
    first = skew.find_cuts(events, ["k"], "ts", "id")
    again = skew.find_cuts(events.withColumn("more", F.lit(1)), ["k"], "ts", "id")
    assert again.points == first.points and probes == ["_hot_keys", "_cut_points"]
    skew.find_cuts(events, ["k"], "v")  # another order: the keys are known, the cut points are not
    assert probes[2:] == ["_cut_points"]
    skew.find_cuts(events, ["kind"], "ts")  # another key
    skew.find_cuts(events.filter("id > 40"), ["k"], "ts", "id")  # other rows
    assert probes.count("_hot_keys") == 3
    spark.conf.set("spark.wardflow.chunkRows", "16")  # another limit
    skew.find_cuts(events, ["k"], "ts", "id")
    assert probes.count("_hot_keys") == 4


def test_a_rewritten_table_is_probed_again(spark, probes, split, tmp_path):
    def write(n):
        spark.range(n).selectExpr("id % 2 AS k", "id AS at").write.mode("overwrite").parquet(str(tmp_path / "t"))
        return spark.read.parquet(str(tmp_path / "t"))

    assert skew.find_cuts(write(8), ["k"], "at") is None
    assert skew.find_cuts(write(400), ["k"], "at") is not None


def test_kept_probes_are_bounded(spark, events, probes, split, monkeypatch):
    monkeypatch.setattr(skew, "KEPT_PROBES", 2)
    for n in range(4):
        skew.find_cuts(events.filter(F.col("id") >= n), ["k"], "ts", "id")
    assert len(skew._ANSWERS[events.sparkSession]) <= 2


@pytest.mark.parametrize("build", [
    lambda o: series.islands(o, ["k"], ["ts", "id"], "kind"),
    lambda o: series.stays(o.with_columns({"stop": F.col("ts") + F.expr("INTERVAL 2 HOURS")}), ["k"], "ts", "stop", "kind", ["id"]),
    lambda o: series.pair_events(o, ["k"], "ts", ["id"], "kind", "a", "b"),
    lambda o: courses.series_summary(o, ["k"], "ts", "v", ["id"]).drop("auc", "time_wt_avg", "cum_sum"),
    lambda o: courses.series_summary(o, ["k", "kind"], "ts", "v", ["id"]).drop("auc", "time_wt_avg", "cum_sum"),
])
def test_operators_chained_on_ordered_rows(spark, events, build):
    both(spark, lambda: build(Ordered(events, ["k"], ["ts", "id"]).whole(last=("max", "ts"))))
