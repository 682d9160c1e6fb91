import math
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import agg, cohort, courses, features, reshape, series


def test_time_to_next_counts_the_last_reading_as_one_hour(frame, rows):
    df = frame("k int, ts timestamp, id int", [(1, "2024-01-01 00:00:00", 1), (1, "2024-01-01 03:00:00", 2), (2, "2024-01-01 00:00:00", 3)])
    assert rows(series.time_to_next(df, ["k"], "ts", ["id"]), "id", "duration") == [(1, 3.0), (2, 1.0), (3, 1.0)]


def test_bands_sum_to_one_hundred(spark, rows):
    rnd = random.Random(3)
    data = [(rnd.randint(1, 4), i, 1_700_000_000 + rnd.randint(0, 10**6), float(rnd.randint(0, 300))) for i in range(200)]
    df = spark.createDataFrame(data, "k int, id int, at bigint, v double").withColumn("ts", F.timestamp_seconds("at"))
    out = series.time_in_band(df, ["k"], "ts", ["id"], "v", {"low": "v < 60", "mid": "v between 60 and 180", "high": "v > 180"})
    assert [r[0] for r in rows(out.select(F.round(F.col("low_pct") + F.col("mid_pct") + F.col("high_pct"), 6)))] == [100.0] * 4


def test_auc_of_one_reading_is_zero(frame, rows):
    df = frame("k int, ts timestamp, id int, v double", [(1, "2024-01-01 00:00:00", 1, 100.0), (1, "2024-01-01 02:00:00", 2, 50.0), (2, "2024-01-01 00:00:00", 3, 9.0)])
    assert rows(series.auc(df, ["k"], "ts", ["id"], "v")) == [(1, 150.0, 2.0, 75.0), (2, 0.0, 0.0, None)]


def test_stays_merge_runs_and_drop_short_rows(frame, rows):
    df = frame("k int, beg timestamp, end timestamp, unit string, id int, disch timestamp", [
        (1, "2024-01-01 00:00:00", "2024-01-01 12:00:00", "A", 1, "2024-01-03"), (1, "2024-01-01 12:00:00", "2024-01-01 12:00:30", "B", 2, "2024-01-03"),
        (1, "2024-01-01 12:00:30", "2024-01-02 00:00:30", "A", 3, "2024-01-03"), (1, "2024-01-02 00:00:30", "2100-12-31", "C", 4, "2024-01-03 00:00:30"),
        (1, "2024-01-04 00:00:00", "2100-12-31", "D", 5, "2024-01-03"), (2, "2024-01-01 00:00:00", None, "A", 6, "2024-01-03"),
    ])
    out = series.stays(df, ["k"], "beg", "end", "unit", ["id"], until="disch")
    assert rows(out, "k", "unit_count", "unit", "unit_los") == [(1, 1, "A", 1.0), (1, 2, "C", 1.0)]


def test_sessions_need_a_gap_above_eight_hours(frame, rows):
    df = frame("k int, beg timestamp, end timestamp, id int", [
        (1, "2024-01-01 00:00:00", "2024-01-01 10:00:00", 1), (1, "2024-01-01 18:00:00", "2024-01-02 00:00:00", 2), (1, "2024-01-02 08:00:01", "2024-01-02 09:00:00", 3),
        (2, "2024-01-01 00:00:00", None, 4),
    ])
    out = series.sessions(df, ["k"], "beg", "end", ["id"], 8)
    assert rows(out) == [(1, 1, "2024-01-01 00:00:00", "2024-01-02 00:00:00", 2), (1, 2, "2024-01-02 08:00:01", "2024-01-02 09:00:00", 1)]


def test_merged_sessions_do_not_merge_again(frame, rows):
    df = frame("k int, beg timestamp, end timestamp, id int", [(1, f"2024-01-{d:02d} 00:00:00", f"2024-01-{d:02d} 20:00:00", d) for d in (1, 2, 3, 7, 8, 12)])
    once = series.sessions(df, ["k"], "beg", "end", ["id"], 8).select("k", F.col("session_start").alias("beg"), F.col("session_end").alias("end"), F.col("session").alias("id"))
    twice = series.sessions(once, ["k"], "beg", "end", ["id"], 8)
    assert rows(once, "k", "beg", "end") == rows(twice, "k", "session_start", "session_end") and once.count() == 3


def test_pairs_skip_a_leading_stop_and_use_fallbacks(frame, rows):
    df = frame("k int, ts timestamp, id int, kind string, disch timestamp", [
        (1, "2024-01-01 00:00:00", 1, "off", "2024-01-09"), (1, "2024-01-02 00:00:00", 2, "on", "2024-01-09"), (1, "2024-01-02 06:00:00", 3, "on", "2024-01-09"),
        (1, "2024-01-03 00:00:00", 4, "off", "2024-01-09"), (1, "2024-01-04 00:00:00", 5, "off", "2024-01-09"), (1, "2024-01-08 00:00:00", 6, "on", "2024-01-09"),
        (1, "2024-01-08 01:00:00", 7, "other", "2024-01-09"), (2, "2024-01-01 00:00:00", 8, "off", "2024-01-09"),
    ])
    out = series.pair_events(df, ["k"], "ts", ["id"], "kind", "on", "off", ["disch"])
    assert rows(out, "k", "pair", "duration_days") == [(1, 1, 1.0), (1, 2, 1.0)]


def test_sustained_needs_two_hours_of_history(frame, rows):
    values = [140, 149, 160, 140, 140, 140, 140, 140]
    df = frame("k int, ts timestamp, id int, v double", [(1, f"2024-01-01 {i // 2:02d}:{30 * (i % 2):02d}:00", i, float(v)) for i, v in enumerate(values)])
    out = series.sustained(df, ["k"], "ts", ["id"], "v", 150, 2)
    assert rows(out) == [(1, "2024-01-01 03:30:00", 3.5)]


def test_lab_change_looks_back_two_days(frame, rows):
    df = frame("k int, ts timestamp, v double", [(1, "2024-01-01 00:00:00", 12.0), (1, "2024-01-02 00:00:00", 11.0), (1, "2024-01-03 00:00:00", 10.0), (1, "2024-01-03 00:00:01", 9.5)])
    assert rows(courses.lab_change(df, ["k"], "ts", "v"), "ts", "change") == [("2024-01-03 00:00:00", -2.0)]


def test_med_runtime_starts_a_course_after_the_gap(frame, rows):
    df = frame("k int, med string, ts timestamp, dose double, id int", [
        (1, "a", "2024-01-01 00:00:00", 5.0, 1), (1, "a", "2024-01-02 00:00:00", 7.0, 2), (1, "a", "2024-01-03 00:00:01", 1.0, 3), (1, "b", "2024-01-01 00:00:00", 2.0, 4),
    ])
    out = courses.med_runtime(df, ["k", "med"], "ts", "dose", ["id"])
    assert rows(out, "med", "course_count", "num_doses", "duration", "first_dose", "last_dose") == [
        ("a", 1, 2, 24.0, 5.0, 7.0), ("a", 2, 1, 0.0, 1.0, 1.0), ("b", 1, 1, 0.0, 2.0, 2.0)]


def test_drips_carry_the_rate_and_weight_by_time(frame, rows):
    df = frame("k int, ts timestamp, rate double, id int", [
        (1, "2024-01-01 00:00:00", 2.0, 1), (1, "2024-01-01 02:00:00", None, 2), (1, "2024-01-01 03:00:00", 0.0, 3), (1, "2024-01-01 04:00:00", 4.0, 4), (1, "2024-01-02 04:00:01", 9.0, 5),
    ])
    runs = courses.drip_runtime(df, ["k"], "ts", "rate", ["id"])
    assert rows(runs, "id", "drip_count", "rate_filled", "duration") == [(1, 1, 2.0, 2.0), (2, 1, 2.0, 1.0), (3, 1, 0.0, 1.0), (4, 1, 4.0, 0.0), (5, 2, 9.0, 0.0)]
    out = courses.summarize_drips(runs, ["k"], "ts", ["id"])
    assert rows(out, "drip_count", "duration", "first_rate", "last_rate", "max_rate", "time_wt_avg_rate", "infusion_run_time") == [
        (1, 4.0, 2.0, 4.0, 4.0, 1.5, 3.0), (2, 0.0, 9.0, 9.0, 9.0, None, 0.0)]


def test_quantiles_interpolate(frame, rows):
    df = frame("k int, v double", [(1, 1.0), (1, 2.0), (1, 4.0), (1, 10.0), (2, 3.0), (1, None)])
    out = agg.summary_stats(df, ["k"], "v")
    assert rows(out, "k", "n", "q25", "median", "q75", "iqr") == [(1, 4, 1.75, 3.0, 5.5, 3.75), (2, 1, 3.0, 3.0, 3.0, 0.0)]


def test_rank_sum_with_ties(frame):
    df = frame("g string, v double", [("a", 1.0), ("a", 2.0), ("a", 2.0), ("b", 2.0), ("b", 3.0), ("b", 4.0)])
    r = agg.rank_sum(df, "g", "a", "b", "v").first()
    assert (r["n_first"], r["n_second"], r["u"]) == (3, 3, 1.0)
    # variance 9/12 * (7 - 24/30) = 4.65, z = (1 - 4.5 + 0.5) / sqrt(4.65)
    assert r["z"] == pytest.approx(-3 / 4.65**0.5) and r["p_approx"] == pytest.approx(math.erfc(3 / 4.65**0.5 / 2**0.5), abs=1e-6)


def test_control_limits(frame, rows):
    df = frame("g int, t int, v double", [(1, i, v) for i, v in enumerate([10.0, 12.0, 11.0])])
    assert rows(agg.control_limits(df, ["g"], ["t"], "v")) == [(1, 11.0, 1.5, 7.01, 14.99)]


def test_overlap_rate_without_prior_items_is_null(frame, rows):
    a, b = frame("k int, med string", [(1, "x"), (1, "y")]), frame("k int, med string", [(1, "x"), (2, "z")])
    assert rows(agg.overlap_rate(a, b, ["k"], "med")) == [(1, 2, 2, 1, 1, 0.5), (2, 1, 0, 1, 0, None)]


def test_aggregate_without_na_skipping(frame, rows):
    df = frame("k int, v double", [(1, 1.0), (1, None), (2, 2.0)])
    assert rows(df.groupBy("k").agg(agg.complete("v", F.sum("v")))) == [(1, None), (2, 2.0)]


def test_flags_are_null_or_filled(frame, rows):
    df = frame("k int, c string", [(1, "a"), (1, "a"), (2, "b"), (2, "zz")])
    assert rows(reshape.flag_pivot(df, ["k"], "c", ["a", "b"], "is_")) == [(1, True, None), (2, None, True)]
    assert rows(reshape.flag_pivot(df, ["k"], "c", ["a", "b"], fill=False)) == [(1, True, False), (2, False, True)]


def test_value_pivot_takes_the_first(frame, rows):
    df = frame("k int, t int, c string, v double", [(1, 2, "a", 5.0), (1, 1, "a", None), (1, 1, "b", 7.0)])
    assert rows(reshape.value_pivot(df, ["k"], "c", ["a", "b"], "v", ["t"])) == [(1, None, 7.0)]


def test_list_cells(frame, rows):
    df = frame("k int, days string", [(1, "a\r\nb\r\n"), (2, "c"), (3, None)])
    assert rows(reshape.explode_list(df, "days", "day")) == [(1, "a"), (1, "b"), (2, "c")]


def test_icd_flags_first_match_wins(frame, rows):
    df = frame("k int, icd string", [(1, "N18.6"), (1, "I10"), (2, "Z00"), (3, "I82x4")])
    out = cohort.icd_flags(df, ["k"], "icd", {"esrd": "N18.6", "ckd": "N18", "htn": "I10", "dvt": "I82.4"})
    assert rows(out) == [(1, None, None, True, True), (3, None, True, None, None)]


def test_attrition(frame, rows):
    df = frame("id int, age int, preg boolean", [(1, 17, None), (2, 30, True), (3, 40, False), (4, None, None)])
    kept, steps = cohort.exclusion_cascade(df, {"minor": F.col("age") < 18, "pregnant": F.col("preg")})
    assert rows(kept, "id") == [(3,), (4,)]
    assert rows(steps, "step_no", "step", "n_rule", "n_left") == [(0, "start", 4, 4), (1, "minor", 1, 3), (2, "pregnant", 1, 2)]


def test_no_exposure_before_index_allows_the_same_instant(frame, rows):
    index = frame("k int, t0 timestamp", [(1, "2024-01-02"), (2, "2024-01-02"), (3, "2024-01-02")])
    doses = frame("k int, ts timestamp", [(1, "2024-01-01"), (1, "2024-01-05"), (2, "2024-01-02")])
    assert rows(features.no_exposure_before(index, doses, ["k"], "t0", "ts"), "k") == [(2,), (3,)]


def test_prior_therapy(frame, rows):
    doses = frame("k int, ts timestamp, med string", [(1, "2024-01-01", "hep"), (1, "2024-01-08", "hep"), (1, "2024-01-09", "war"), (2, "2024-01-01", "hep"), (3, "2024-01-09", "hep")])
    index = frame("k int, t0 timestamp, loaded boolean", [(1, "2024-01-10", False), (2, "2024-01-10", False), (3, "2024-01-10", True)])
    out = features.prior_therapy(doses, index, ["k"], "ts", "med", "t0", "loaded")
    assert rows(out, "k", "medication", "duration", "stop_to_index", "full_load", "other_load") == [(1, "war", 7.0, 1.0, True, True), (3, "hep", 0.0, 1.0, True, False)]


def test_io_balance(frame, rows):
    df = frame("k int, ts timestamp, kind string, vol double, event string", [
        (1, "2024-01-02 06:00:00", "IN", 500.0, "iv"), (1, "2024-01-02 08:00:00", "OUT", 200.0, "indwelling cath"), (1, "2024-01-03 06:00:00", "IN", 100.0, "iv")])
    by_date = features.io_balance(df, ["k"], "ts", "kind", "vol", F.col("event").contains("cath"))
    assert rows(by_date, "event_date", "io_in", "io_out", "io_net", "catheter") == [("2024-01-02 00:00:00", 500.0, 200.0, 300.0, True), ("2024-01-03 00:00:00", 100.0, 0.0, 100.0, False)]
    by_shift = features.io_balance(df, ["k"], "ts", "kind", "vol", F.col("event").contains("cath"), "shift")
    assert rows(by_shift, "event_date", "io_in", "io_net") == [("2024-01-01 00:00:00", 500.0, 500.0), ("2024-01-02 00:00:00", 100.0, -100.0)]


def test_blood_products_from_two_sources(frame, rows):
    make = "k int, ts timestamp, t0 timestamp, product string, vol double"
    issued = frame(make, [(1, "2024-01-01 03:00:00", "2024-01-01", "RBC leuko", 300.0), (1, "2024-01-01 05:00:00", "2024-01-01", "FFP", 200.0)])
    charted = frame(make, [(1, "2024-01-01 01:00:00", "2024-01-01", "Cryo", 0.0), (2, "2024-01-01 01:00:00", "2024-01-01", "Plasma", 250.0)])
    out = features.blood_products(issued, charted, ["k"], "ts", "t0", "product", "vol")
    assert rows(out, "k", "blood_prbc", "blood_ffp", "blood_cryo", "prod_prbc", "io_ffp") == [(1, True, False, False, 300.0, None), (2, False, True, False, None, 250.0)]


def test_snapshots(frame, rows):
    df = frame("k int, ts timestamp, t0 timestamp, lab string, v double", [
        (1, "2024-01-01 01:00:00", "2024-01-01", "na", 1.0), (1, "2024-01-01 22:00:00", "2024-01-01", "na", 2.0), (1, "2024-01-05 00:00:00", "2024-01-01", "na", 3.0)])
    assert rows(features.timed_snapshots(df, ["k"], "ts", "t0", "lab", "v"), "timing", "v") == [("ADMIT", 1.0), ("DISCH", 3.0), ("HR24", 2.0)]


def test_culture_positive(frame, rows):
    df = frame("k int, lab string, txt string", [(1, "blood", "NO GROWTH"), (1, "resp", "Yeast"), (2, "blood", "E. coli"), (3, "urine", "yeast")])
    out = features.culture_positive(df, ["k"], "lab", "txt", ["blood", "resp", "urine"], not_counted={"resp": "(?i)yeast"})
    assert rows(out) == [(2, True, None, None), (3, None, None, True)]


def test_drugs_after_any_index(frame, rows):
    index = frame("k int, a timestamp, b timestamp", [(1, "2024-01-05", None), (2, None, None), (3, "2024-01-09", "2024-01-01")])
    doses = frame("k int, ts timestamp, med string", [(1, "2024-01-04", "x"), (1, "2024-01-06", "y"), (2, "2024-01-06", "x"), (3, "2024-01-02", "x")])
    assert rows(features.med_after_index(index, doses, ["k"], "ts", "med", ["x", "y"], ["a", "b"])) == [(1, None, True), (2, None, None), (3, True, None)]
