import pytest
from pyspark.sql import functions as F

from wardflow.operators import joins, pick


@pytest.fixture
def visits(frame):
    return frame("k int, ts timestamp, id int, v double", [
        (1, "2024-01-01 00:00:00", 2, 5.0), (1, "2024-01-01 00:00:00", 1, 9.0), (1, "2024-01-02 00:00:00", 3, None),
        (2, "2024-01-05 00:00:00", 4, 1.0), (None, "2024-01-01 00:00:00", 5, 3.0), (None, None, 6, 4.0),
    ])


def test_pick_first_breaks_ties(visits, rows):
    assert rows(pick.pick_first(visits, ["k"], ["ts", "id"]), "k", "id") == [(None, 6), (1, 1), (2, 4)]
    assert rows(pick.pick_last(visits, ["k"], ["ts", "id"]), "k", "id") == [(None, 5), (1, 3), (2, 4)]


def test_pick_with_ties_keeps_all_of_them(frame, rows):
    df = frame("k int, v int, id int", [(1, 1, 1), (1, 2, 2), (1, 2, 3), (1, 2, 4), (1, 3, 5), (None, 1, 6)])
    assert rows(pick.pick_first(df, ["k"], ["v"], 2, ties=True), "id") == [(1,), (2,), (3,), (4,), (6,)]


def test_top_mean_counts_tied_values(frame, rows):
    df = frame("k int, v double", [(1, 10.0), (1, 8.0), (1, 8.0), (1, 8.0), (1, 1.0), (2, 5.0), (3, None)])
    assert rows(pick.top_mean(df, ["k"], "v", 3)) == [(1, 8.5), (2, 5.0)]


def test_nearest_prefers_the_earlier_of_two_equal_distances(frame, rows):
    df = frame("k int, anchor timestamp, ts timestamp, id int, v double", [
        (1, "2024-01-01", "2024-01-01 05:00:00", 1, 5.0), (1, "2024-01-01", "2024-01-01 07:00:00", 2, 7.0), (1, "2024-01-01", "2024-01-01 23:00:00", 3, None),
    ])
    out = pick.nearest(df, ["k"], "ts", "anchor", [6, 24], ["v"], ["id"])
    assert rows(out) == [(1, 5.0, None)]


def test_keep_rules(frame, rows):
    df = frame("k int, t int, v double", [(1, 1, 5.0), (1, 1, 3.0), (1, 1, None), (1, 2, 8.0), (1, 2, 6.0), (2, 1, None)])
    out = df.groupBy("k").agg(
        pick.keep_first("v", ["t"], "min"), pick.keep_first("v", ["t"], "max"), pick.keep_last("v", ["t"], "min"), pick.keep_last("v", ["t"], "max"))
    assert rows(out) == [(1, 3.0, 5.0, 6.0, 8.0), (2, None, None, None, None)]


def test_first_when_never_true_is_null(frame, rows):
    df = frame("k int, ts timestamp, v double", [(1, "2024-01-01 00:00:00", 9.0), (1, "2024-01-01 03:00:00", 1.0), (2, "2024-01-01 00:00:00", 9.0)])
    assert rows(pick.first_when(df, ["k"], "ts", F.col("v") < 5, "goal"), "k", "goal_hours") == [(1, 3.0), (2, None)]


STATES = [
    (1, "2024-01-01 08:00:00", "2024-01-01 12:00:00", "A", 1), (1, "2024-01-01 12:00:00", "2024-01-01 18:00:00", "B", 2),
    (1, "2024-01-01 12:00:00", "2024-01-01 18:00:00", "C", 3), (2, "2024-01-01 00:00:00", None, "D", 4), (None, "2024-01-01 00:00:00", "2030-01-01", "N", 5),
]
EVENTS = [
    (1, "2024-01-01 07:59:59", 1), (1, "2024-01-01 08:00:00", 2), (1, "2024-01-01 12:00:00", 3), (1, "2024-01-01 20:00:00", 4), (2, "2024-02-01 00:00:00", 5),
    (3, "2024-01-01 00:00:00", 6), (1, None, 7),
]


@pytest.fixture
def states(frame):
    return frame("k int, beg timestamp, end timestamp, unit string, sid int", STATES)


@pytest.fixture
def events(frame):
    return frame("k int, ts timestamp, id int", EVENTS)


def test_asof_takes_the_latest_state_and_breaks_ties(events, states, rows):
    out = joins.asof_join(events, states, ["k"], "ts", "beg", ["unit"], ["sid"])
    assert rows(out, "id", "unit") == [(1, None), (2, "A"), (3, "C"), (4, "C"), (5, "D"), (6, None), (7, None)]


def test_asof_strict_looks_before_the_event(events, states, rows):
    out = joins.asof_join(events, states, ["k"], "ts", "beg", ["unit"], ["sid"], strict=True)
    assert rows(out, "id", "unit") == [(1, None), (2, None), (3, "A"), (4, "C"), (5, "D"), (6, None), (7, None)]


def test_asof_state_must_be_valid(events, states, rows):
    out = joins.asof_join(events, states, ["k"], "ts", "beg", ["unit"], ["sid"], valid_from="beg", valid_to="end", how="inner")
    assert rows(out, "id", "unit") == [(2, "A"), (3, "C")]


def test_interval_join_bounds(frame, rows):
    points = frame("k int, ts timestamp, id int", [(1, "2024-01-01 00:00:00", 1), (1, "2024-01-02 00:00:00", 2), (1, "2024-01-01 12:00:00", 3), (None, "2024-01-01 12:00:00", 4)])
    spans = frame("k int, beg timestamp, end timestamp", [(1, "2024-01-01", "2024-01-02"), (1, "2024-01-02", None), (1, "2024-01-03", "2024-01-01"), (None, "2024-01-01", "2024-01-02")])
    ids = {c: [r[0] for r in rows(joins.interval_join(points, spans, ["k"], "ts", "beg", "end", c), "id")] for c in ("both", "left", "right", "neither")}
    assert ids == {"both": [1, 2, 3], "left": [1, 3], "right": [2, 3], "neither": [3]}
    left = joins.interval_join(points, spans, ["k"], "ts", "beg", "end", "neither", how="left")
    assert rows(left, "id", "beg") == [(1, None), (2, None), (3, "2024-01-01 00:00:00"), (4, None)]


def test_overlap_counts_touching_spans(frame, rows):
    a = frame("k int, a0 timestamp, a1 timestamp", [(1, "2024-01-01", "2024-01-02")])
    b = frame("k int, b0 timestamp, b1 timestamp, id int", [(1, "2024-01-02", "2024-01-03", 1), (1, "2023-12-01", "2023-12-31", 2), (1, "2023-12-01", "2024-02-01", 3), (1, "2024-01-01", None, 4)])
    assert rows(joins.overlap_join(a, b, ["k"], "a0", "a1", "b0", "b1"), "id") == [(1,), (3,)]


def test_readmission_window_is_open_at_discharge(frame, rows):
    enc = frame("p int, id int, start timestamp, end timestamp", [
        (1, 1, "2024-01-01", "2024-01-05"), (1, 2, "2024-01-05", "2024-01-06"), (1, 3, "2024-02-01", "2024-02-03"), (2, 4, "2024-01-10", "2024-01-11"),
    ])
    assert rows(joins.look_forward(enc, "p", "start", "end", 30, ["id"]), "id", "next_id") == [(1, 3), (2, 3)]
    assert rows(joins.look_back(enc, "p", "start", "end", 1, [], "id"), "id", "prior_id") == [(2, 1)]


def test_first_state_skips_and_requires(frame, rows):
    df = frame("k int, ts timestamp, unit string", [(1, "2024-01-01 00:00:00", "ED"), (1, "2024-01-01 01:00:00", "ICU"), (2, "2024-01-01 00:00:00", "WARD"), (2, "2024-01-02", "ICU")])
    assert rows(joins.first_state(df, ["k"], ["ts"], "unit", ["ED"], ["ICU"]), "k") == [(1,)]


def test_decode_keeps_unknown_codes(frame, rows):
    df = frame("a int, b int", [(1, 2), (9, None)])
    codes = frame("code int, display string", [(1, "one"), (2, "two")])
    assert rows(joins.decode_codes(df, codes, "code", "display", {"a": "a_text", "b": "b_text"})) == [(1, 2, "one", "two"), (9, None, None, None)]


def test_reconcile(frame, rows):
    a, b = frame("k int", [(1,), (2,), (2,)]), frame("k int", [(2,), (3,)])
    assert rows(joins.reconcile(a, b, ["k"])) == [(1, "left_only"), (2, "both"), (3, "right_only")]


def test_assemble_keeps_every_base_row(frame, rows):
    base, part = frame("k int", [(1,), (2,)]), frame("k int, x int", [(2, 5)])
    assert rows(joins.assemble(base, [part], "k")) == [(1, None), (2, 5)]


def test_asof_takes_the_valid_state_of_a_tied_instant(frame, rows):
    events = frame("k bigint, at timestamp", [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 13:00:00")])
    states = frame("k bigint, st timestamp, beg timestamp, fin timestamp, sid bigint, name string", [
        (1, "2024-01-01 09:00:00", "2024-01-01 09:00:00", "2024-01-01 12:00:00", 1, "A"),
        (1, "2024-01-01 09:00:00", "2024-01-01 08:00:00", "2024-01-01 09:30:00", 2, "B"),
    ])
    got = joins.asof_join(events, states, ["k"], "at", "st", ["name"], ["sid"], valid_from="beg", valid_to="fin")
    assert rows(got, "at", "name") == [("2024-01-01 10:00:00", "A"), ("2024-01-01 13:00:00", None)]


def test_asof_splits_many_states_of_one_instant(spark, frame, rows):
    start = "2024-01-01 00:00:00"
    states = spark.range(3000).selectExpr(
        "if(id < 2990, cast(null as bigint), 1) as k", f"timestamp'{start}' as st", f"timestamp'{start}' + make_interval(0,0,0,0,0,0,id % 2990) as beg",
        f"timestamp'{start}' + make_interval(0,0,0,0,0,0,id % 2990 + 9) as fin", "id as sid",
    )
    events = frame("k bigint, at timestamp, e int", [
        (None, "2024-01-01 00:10:00", 1), (None, "2024-01-01 00:10:00", 1), (None, "2024-01-02 00:00:00", 2), (1, "2024-01-01 00:00:02", 3), (1, None, 4), (1, "2023-12-31 00:00:00", 5), (2, start, 6),
    ])
    got = joins.asof_join(events, states, ["k"], "at", "st", ["sid"], ["sid"], valid_from="beg", valid_to="fin")
    assert rows(got, "e", "sid") == [(1, 600), (1, 600), (2, None), (3, 2992), (4, None), (5, None), (6, None)]
    inner = joins.asof_join(events, states, ["k"], "at", "st", ["sid"], ["sid"], strict=True, valid_from="beg", valid_to="fin", how="inner")
    assert rows(inner, "e", "sid") == [(1, 600), (1, 600), (3, 2992)]
    # No row holds all states of an instant.
    assert "collect_list" not in got._jdf.queryExecution().toString()
