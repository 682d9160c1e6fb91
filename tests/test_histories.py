"""State at event time from several histories, and the work that dense instants, windows and keys cost."""

import datetime as dt
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from wardflow.operators import agg, features, joins, series, skew
from wardflow.operators.joins import History, asof_histories
from wardflow.operators.series import Ordered
from wardflow.plans import run
from wardflow.sources.write import write_bucketed


def hour(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


@pytest.fixture
def light(spark):
    """Tiny data and wide plans: compiling them would take most of the time."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def given(spark):
    rnd = random.Random(3)
    events = [(rnd.choice([1, 2, None]), i, hour(rnd.randint(0, 40)) if rnd.random() < 0.95 else None) for i in range(200)]
    places = [
        (rnd.choice([1, 2, None]), hour(rnd.randint(0, 12) * 3), rnd.randint(0, 5), rnd.choice("abc"), hour(rnd.randint(-5, 45)) if rnd.random() < 0.9 else None, hour(rnd.randint(0, 45)) if rnd.random() < 0.9 else None)
        for _ in range(120)
    ]
    weights = [(k, hour(rnd.randint(0, 40)), rnd.randint(0, 99)) for k in (1, 2, None) for _ in range(10)]
    frames = (
        spark.createDataFrame(events, "k int, id int, t timestamp"), spark.createDataFrame(places, "k int, at timestamp, tie int, place string, beg timestamp, end timestamp"),
        spark.createDataFrame(weights, "k int, weighed timestamp, weight int"),
    )
    return events, places, weights, *frames


def brute(events, places, weights, strict, beg, end):
    out = {}
    for k, i, t in events:
        def seen(rows):
            return [r for r in rows if r[0] == k and t is not None and (r[1] < t if strict else r[1] <= t)]

        before = seen(places)
        latest = [r for r in before if r[1] == max(x[1] for x in before) and (not beg or r[4] is not None and r[4] <= t) and (not end or r[5] is not None and r[5] >= t)]
        place = max(latest, key=lambda r: (r[2], r[3]))[3] if latest else None
        weighed = seen(weights)
        out[i] = (place, max(weighed, key=lambda r: r[1:])[2] if weighed else None)
    return out


@pytest.mark.parametrize("beg,end", [(True, True), (True, False), (False, True), (False, False)])
@pytest.mark.parametrize("strict", [False, True])
def test_two_histories_equal_brute_force(spark, light, given, strict, beg, end):
    events, places, weights, e, p, w = given
    histories = [History(p, "at", ["place"], ["tie", "place"], "beg" if beg else None, "end" if end else None), History(w, "weighed", ["weight"], ["weight"])]
    got = {r.id: (r.place, r.weight) for r in asof_histories(e, histories, ["k"], "t", strict).collect()}
    expected = brute(events, places, weights, strict, beg, end)
    assert got == expected
    inner = asof_histories(e, histories, ["k"], "t", strict, "inner").select("id").collect()
    assert {r.id for r in inner} == {i for i, found in expected.items() if None not in found}


def test_two_histories_with_hot_keys(spark, light, given, split):
    events, places, weights, e, p, w = given
    histories = [History(p, "at", ["place"], ["tie", "place"], "beg", "end"), History(w, "weighed", ["weight"], ["weight"])]
    got = {r.id: (r.place, r.weight) for r in asof_histories(e, histories, ["k"], "t").collect()}
    assert got == brute(events, places, weights, False, True, True)


def test_events_with_map_columns(spark, given):
    _, _, _, e, p, _ = given
    for size in ("0", str(2**40)):
        spark.conf.set("spark.wardflow.probeBytes", size)
        try:
            mapped = e.withColumn("props", F.create_map(F.lit("a"), F.col("id")))
            out = joins.asof_join(mapped, p.select("k", "at", "place", "tie"), ["k"], "t", "at", ["place"], ["tie", "place"])
            assert out.count() == e.count() and out.filter("props['a'] = id").count() == e.count()
        finally:
            spark.conf.unset("spark.wardflow.probeBytes")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_several_histories_need_one_exchange(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    one = orders.select("o_custkey", F.col("o_orderdate").alias("a_at"), F.col("o_orderkey").alias("a"))
    two = orders.select("o_custkey", F.col("o_orderdate").alias("b_at"), F.col("o_totalprice").alias("b"))
    events = orders.select("o_custkey", "o_orderkey", "o_orderdate")
    text = plan(asof_histories(events, [History(one, "a_at", ["a"], ["a"]), History(two, "b_at", ["b"], ["b"])], ["o_custkey"], "o_orderdate"))
    assert len(re.findall(r"Exchange", text)) == 1 and "Join" not in text


def test_many_states_of_one_instant_cost_no_square(spark):
    """10,000 states of one instant and 10,000 later events: a pair each would be 100 million rows."""
    n = 10_000
    states = spark.range(n).selectExpr("1 AS k", "timestamp_seconds(0) AS at", "id AS tie", "timestamp_seconds(id) AS beg", "timestamp_seconds(id + 1 + pmod(id * 7919, 5000)) AS end")
    events = spark.range(n).selectExpr("1 AS k", "id", "timestamp_seconds(id * 2) AS t")
    began = time.time()
    out = joins.asof_join(events, states, ["k"], "t", "at", ["tie"], ["tie"], valid_from="beg", valid_to="end")
    got = {r.id: r.tie for r in out.collect()}
    assert time.time() - began < 60
    expected = {}
    spans = sorted((i, i + 1 + i * 7919 % 5000) for i in range(n))
    for i in range(0, n, 371):
        t = i * 2
        valid = [s for s, e in spans if s <= t <= e]
        expected[i] = max(valid) if valid else None
    assert {i: got[i] for i in expected} == expected


def test_every_tied_state(spark, given):
    events, places, _, e, p, _ = given
    got = sorted((r.id, r.tie, r.place) for r in joins.asof_tied(e.filter("k is not null"), p, ["k"], "t", "at", ["tie", "place"], "beg", "end").collect())
    expected = []
    for k, i, t in events:
        before = [r for r in places if r[0] == k and k is not None and t is not None and r[1] <= t]
        expected += [(i, r[2], r[3]) for r in before if r[1] == max(x[1] for x in before) and r[4] is not None and r[5] is not None and r[4] <= t <= r[5]]
    assert got == sorted(expected)


# -- hot keys ordered by texts, bytes and intervals


@pytest.mark.parametrize("column", ["text", "bytes", "span", "months"])
def test_hot_keys_are_cut_along_any_order(spark, column):
    """Ids that share a long prefix, bytes and intervals: on both sides of the size limit, and in even chunks."""
    df = spark.range(1000).selectExpr(
        "1 AS k", "id", "format_string('ACCT-%08d', id) AS text", "cast(format_string('%05d', id) AS binary) AS bytes", "make_dt_interval(0, id) AS span", "make_ym_interval(0, cast(id AS int)) AS months",
    ).repartition(4)

    def build():
        return Ordered(df, ["k"], [column]).look(before=("lag", "id"), total=("sum", "id"))

    plain = sorted(map(str, build().result().select("id", "before", "total").collect()))
    for size in ("0", str(2**40)):
        spark.conf.set("spark.wardflow.probeBytes", size)
        spark.conf.set("spark.wardflow.chunkRows", "50")
        try:
            cut = build()
            assert sorted(map(str, cut.result().select("id", "before", "total").collect())) == plain
            if size == "0":
                largest = cut.df.groupBy("_chunk").count().agg(F.max("count"), F.count("*")).first()
                assert largest[0] <= 100 and largest[1] >= 15
        finally:
            spark.conf.unset("spark.wardflow.probeBytes")
            spark.conf.unset("spark.wardflow.chunkRows")


def test_crowded_texts_are_cut_by_the_tie(spark, split):
    df = spark.range(300).selectExpr("1 AS k", "id", "if(id % 3 = 0, 'same', concat('t', id)) AS text")
    marked = Ordered(df, ["k"], ["text", "id"])
    assert marked.df.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 60
    spark.conf.set("spark.wardflow.probeBytes", str(2**40))
    plain = Ordered(df, ["k"], ["text", "id"]).look(n=("sum", "id")).result().collect()
    spark.conf.set("spark.wardflow.probeBytes", "0")
    assert sorted(map(str, marked.look(n=("sum", "id")).result().select("k", "id", "text", "n").collect())) == sorted(map(str, plain))


# -- windows, intervals, lists


def test_dense_windows_are_linear(spark):
    """A million rows of one key in one window: a RANGE frame would read each row's frame again."""
    df = spark.range(1_000_000).selectExpr("1 AS k", "id", "timestamp_micros(id * 7000) AS ts", "cast(pmod(id * 7919, 100003) AS double) AS v")
    began = time.time()
    top = series.rolling(df, ["k"], "ts", "v", 2, "max", "r").agg(F.max("r"), F.min("r"), F.count("*")).first()
    assert top[0] == 100002 and top[2] == 1_000_000 and time.time() - began < 90


@pytest.mark.parametrize("fn", ["max", "avg", "count"])
def test_dense_and_plain_windows_agree(spark, fn):
    df = spark.range(500).selectExpr("id % 3 AS k", "id", "timestamp_seconds(id * 60) AS ts", "if(id % 7 = 0, null, cast(id * 13 % 101 AS double)) AS v")
    plain = sorted(map(str, series.rolling(df, ["k"], "ts", "v", 1, fn, "r").collect()))
    spark.conf.set("spark.wardflow.denseRows", "1")
    try:
        assert sorted(map(str, series.rolling(df, ["k"], "ts", "v", 1, fn, "r").collect())) == plain
    finally:
        spark.conf.unset("spark.wardflow.denseRows")


@pytest.mark.parametrize("closed", ["both", "left", "right", "neither"])
def test_left_interval_join_with_map_columns(spark, closed):
    rnd = random.Random(4)
    points = spark.createDataFrame([(rnd.choice([1, 2, None]), i, hour(rnd.randint(0, 30)) if i % 9 else None, {"a": i}) for i in range(90)], "k int, id int, t timestamp, props map<string,int>")
    spans = spark.createDataFrame([(rnd.choice([1, 2, None]), j, hour(a), hour(a + rnd.randint(-1, 4))) for j, a in enumerate(rnd.choices(range(30), k=40))], "k int, span int, beg timestamp, end timestamp")
    out = []
    for size in (str(2**40), "0"):
        spark.conf.set("spark.wardflow.probeBytes", size)
        try:
            got = joins.interval_join(points, spans, ["k"], "t", "beg", "end", closed, "left").select("k", "id", "t", "props", "span", "beg", "end")
            out.append(sorted(map(str, got.collect())))
        finally:
            spark.conf.unset("spark.wardflow.probeBytes")
    assert out[0] == out[1] and len(out[0]) >= 90


def test_long_lists_are_built_in_chunks(spark, split):
    df = spark.range(400).selectExpr("if(id < 300, 1, id) AS k", "id AS n", "concat('x', id % 90) AS text")
    hot = agg.text_list(df, ["k"], "text", ["n"], "; ", "items")
    assert "_chunk" in hot._jdf.queryExecution().toString()
    got = {r.k: r["items"] for r in hot.collect()}
    assert got[1] == "; ".join(f"x{i % 90}" for i in range(300)) and got[350] == "x80"


def test_assembly_of_stored_parts_moves_nothing(spark, tmp_path):
    base = spark.range(200).selectExpr("id AS k", "id * 2 AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = [base.filter(f"k % {i} = 0").selectExpr("k", f"v + {i} AS p{i}") for i in range(2, 7)]
        plainly = joins.assemble(base, [p.groupBy("k").agg(F.max(p.columns[1]).alias(p.columns[1])) for p in parts], "k")
        assert plan(plainly).count("Exchange") <= 6  # the base once, every part once for its own aggregate
        stored = [write_bucketed(p, f"assembly_{i}", "k", 4, str(tmp_path / f"p{i}")) for i, p in enumerate([base, *parts])]
        out = joins.assemble(stored[0], stored[1:], "k")
        assert "Exchange" not in plan(out)
        assert sorted(map(str, out.collect())) == sorted(map(str, plainly.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for i in range(6):
            spark.sql(f"DROP TABLE IF EXISTS assembly_{i}")


@pytest.mark.parametrize("name", ["prior_therapy_before_index", "drugs_after_index"])
def test_therapy_queries_reduce_before_they_join(spark, name):
    text = plan(run(name, spark, "/root/testdata/sf0.001"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_prior_therapy_of_several_index_rows(frame, rows):
    doses = frame("k int, ts timestamp, med string", [(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-04 00:00:00", "a"), (1, "2024-01-08 00:00:00", "a"), (1, "2024-01-03 00:00:00", "b"), (2, "2024-01-03 00:00:00", "b")])
    index = frame("k int, t0 timestamp, loaded boolean", [(1, "2024-01-05 00:00:00", True), (1, "2024-01-05 00:00:00", True), (1, "2024-01-09 00:00:00", False), (3, "2024-01-09 00:00:00", False)])
    out = features.prior_therapy(doses, index, ["k"], "ts", "med", "t0", "loaded")
    assert rows(out, "k", "loaded", "medication", "duration", "stop_to_index") == [(1, False, "a", 7.0, 1.0), (1, True, "a", 3.0, 1.0)]


def test_skew_rejects_only_unordered_columns(spark):
    df = spark.range(3).selectExpr("id", "array(id) AS a")
    with pytest.raises(TypeError):
        skew.order_number(df, "a")


# -- large tables of ordinary keys

@pytest.fixture
def large(spark):
    """Tables count as large, no key as hot."""
    spark.conf.set("spark.wardflow.probeBytes", "0")
    yield
    spark.conf.unset("spark.wardflow.probeBytes")


@pytest.mark.parametrize("name", ["interval_overlap_join", "validity_overlap_join", "point_in_interval_join", "asof_every_tied_state"])
def test_rows_of_ordinary_keys_are_not_dealt_to_bins(spark, large, name):
    assert "Generate" not in plan(run(name, spark, "/root/testdata/sf0.001"))


def test_only_crowded_keys_are_dealt_to_bins(spark, large, light, monkeypatch):
    monkeypatch.setattr(skew, "MEET_ROWS", 8)
    rnd = random.Random(5)
    keys = [1] * 60 + [2] * 3 + [None] * 40
    a = [(k, i, hour(rnd.randint(0, 90)), rnd.randint(0, 20)) for i, k in enumerate(keys)]
    b = [(k, i, hour(rnd.randint(0, 90)), rnd.randint(0, 20)) for i, k in enumerate(keys)]
    left = spark.createDataFrame(a, "k int, a int, a0 timestamp, n int").selectExpr("k", "a", "a0", "a0 + make_interval(0,0,0,0,n) AS a1")
    right = spark.createDataFrame(b, "k int, b int, b0 timestamp, n int").selectExpr("k", "b", "b0", "b0 + make_interval(0,0,0,0,n) AS b1")
    assert skew.crowded_keys(left, right, ["k"]) == [r.h for r in spark.sql("SELECT xxhash64(1) AS h").collect()]
    got = joins.overlap_join(left, right, ["k"], "a0", "a1", "b0", "b1")
    hours = dt.timedelta(hours=1)
    met = {(x[1], y[1]) for x in a for y in b if x[0] == y[0] is not None and x[2] <= y[2] + y[3] * hours and y[2] <= x[2] + x[3] * hours}
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(met)
    got = joins.interval_join(left, right, ["k"], "a0", "b0", "b1", how="left")
    inside = [(x[1], y[1]) for x in a for y in b if x[0] == y[0] is not None and y[2] <= x[2] <= y[2] + y[3] * hours]
    alone = {x[1] for x in a} - {i for i, _ in inside}
    assert sorted((r.a, -1 if r.b is None else r.b) for r in got.collect()) == sorted([*inside, *((i, -1) for i in alone)])


def test_steps_of_ordinary_keys_stay_where_their_states_are(spark, large):
    text = plan(run("asof_two_histories", spark, "/root/testdata/sf0.001"))
    # The events' exchange, one of each history, and what joins the owners to its rows; the steps of crowded instants come on top.
    after = text.split("Union")[0]
    assert "Window" in after and "Exchange" not in after


@pytest.mark.parametrize("few", [1, 2, 8])
def test_calm_steps_equal_brute_force(light, large, given, monkeypatch, few):
    monkeypatch.setattr(joins, "_FEW", few)
    events, places, weights, e, p, w = given
    out = asof_histories(e, [History(p, "at", ["place"], ["tie"], "beg", "end"), History(w, "weighed", ["weight"])], ["k"], "t")
    assert {r.id: (r.place, r.weight) for r in out.collect()} == brute(events, places, weights, False, True, True)


def test_prior_therapy_of_ordinary_keys_reads_doses_once(spark, large, frame, rows):
    text = plan(run("prior_therapy_before_index", spark, "/root/testdata/sf0.001"))
    assert len(re.findall(r"FileScan parquet \[l_", text)) == 2
    test_prior_therapy_of_several_index_rows(frame, rows)
