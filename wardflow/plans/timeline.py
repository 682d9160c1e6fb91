"""Windows and time series."""

from pyspark.sql import functions as F

from ..functions.scalar import elapsed, fiscal_year, offset, shift_day
from ..operators import series
from ..operators.joins import merge_full
from .registry import days, hours, query

W = "(PARTITION BY user_id ORDER BY ts, event_id)"
KEY, TS, TIE = ["user_id"], "ts", ["event_id"]


@query("lag_and_lead", "G1", f"""
    SELECT event_id, lag(value) OVER {W} AS prev_value, lead(value) OVER {W} AS next_value, coalesce(lag(event_type) OVER {W} IS DISTINCT FROM event_type, TRUE) AS type_changed FROM events
""")
def lag_and_lead(t):
    out = series.neighbours(t.events, KEY, [TS, *TIE], prev_value=("lag", "value"), next_value=("lead", "value"), _pt=("lag", "event_type"))
    return out.select("event_id", "prev_value", "next_value", (~F.col("_pt").eqNullSafe(F.col("event_type"))).alias("type_changed"))


@query("time_to_next_reading", "G2", f"SELECT event_id, coalesce({hours('ts', f'lead(ts) OVER {W}')}, 1e0) AS duration FROM events")
def time_to_next_reading(t):
    return series.time_to_next(t.events, KEY, TS, TIE).select("event_id", "duration")


@query("change_measures", "G3", f"""
    SELECT event_id, value - lag(value) OVER {W} AS chg_prev, value - first_value(value) OVER {W} AS chg_first, (value - first_value(value) OVER {W}) / nullif(first_value(value) OVER {W}, 0) AS chg_first_pct,
           (value - lag(value) OVER {W}) / {hours(f'lag(ts) OVER {W}', 'ts')} AS chg_per_hour FROM events
""")
def change_measures(t):
    return series.changes(t.events, KEY, TS, TIE, "value").select("event_id", "chg_prev", "chg_first", "chg_first_pct", "chg_per_hour")


@query("two_consecutive_below", "G4", f"SELECT event_id, coalesce(value < 30 AND lag(value) OVER {W} < 30, FALSE) AS two_below FROM events")
def two_consecutive_below(t):
    return series.consecutive_below(t.events, KEY, TS, TIE, "value", 30).select("event_id", "two_below")


@query("cumulative_time_below", "G5", f"""
    WITH g AS (SELECT *, coalesce({hours('ts', f'lead(ts) OVER {W}')}, 1e0) AS d FROM events)
    SELECT event_id, round(sum(CASE WHEN value < 30 THEN d ELSE 0 END) OVER ({W[1:-1]} ROWS UNBOUNDED PRECEDING), 4) AS hours_below, sum(CASE WHEN value < 30 THEN 1 ELSE 0 END) OVER ({W[1:-1]} ROWS UNBOUNDED PRECEDING)::BIGINT AS n_below FROM g
""")
def cumulative_time_below(t):
    rows = series.time_to_next(t.events, KEY, TS, TIE)
    low = F.col("value") < 30
    out = series.running(
        rows, KEY, [TS, *TIE], hours_below=("sum", F.when(low, F.col("duration")).otherwise(0.0)), n_below=("sum", F.when(low, 1).otherwise(0).cast("bigint"))
    )
    return out.select("event_id", F.round("hours_below", 4).alias("hours_below"), "n_below")


@query("label_islands", "G6", f"""
    WITH c AS (SELECT *, CASE WHEN lag(event_type) OVER {W} IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS n FROM events)
    SELECT event_id, sum(n) OVER {W}::BIGINT AS island FROM c
""")
def label_islands(t):
    return series.islands(t.events, KEY, [TS, *TIE], "event_type").select("event_id", "island")


@query("unit_stays", "G6 B12 K12", f"""
    WITH h AS (SELECT *, lead(ts) OVER {W} AS stop, max(ts) OVER (PARTITION BY user_id) AS disch FROM events),
    r AS (SELECT *, {days('ts', 'CASE WHEN stop IS NOT NULL THEN least(stop, disch) END')} AS len FROM h WHERE disch >= ts),
    f AS (SELECT * FROM r WHERE len >= 60e0 / 1440), c AS (SELECT *, CASE WHEN lag(event_type) OVER {W} IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS n FROM f),
    u AS (SELECT *, sum(n) OVER {W}::BIGINT AS unit_count FROM c)
    SELECT user_id, unit_count, event_type AS unit, min(ts) AS unit_in_datetime, max(stop) AS unit_out_datetime, round(sum(len), 6) AS unit_los FROM u GROUP BY 1, 2, 3
""")
def unit_stays(t):
    history = series.Ordered(t.events.drop("props"), KEY, [TS, *TIE]).look(stop=("lead", "ts")).whole(disch=("max", "ts"))
    out = series.stays(history.with_columns({"unit": F.col("event_type")}), KEY, TS, "stop", "unit", TIE, until="disch", min_minutes=60)
    return out.withColumn("unit_los", F.round("unit_los", 6))


@query("gap_sessions", "G7", f"""
    WITH g AS (SELECT *, CASE WHEN {hours(f'lag(ts + INTERVAL 1 HOUR) OVER {W}', 'ts')} > 8 OR lag(ts) OVER {W} IS NULL THEN 1 ELSE 0 END AS n FROM events),
    s AS (SELECT *, sum(n) OVER {W}::BIGINT AS session FROM g)
    SELECT user_id, session, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, count(*) AS n_rows FROM s GROUP BY 1, 2
""")
def gap_sessions(t):
    return series.sessions(t.events.withColumn("stop", offset("ts", 1)), KEY, TS, "stop", TIE, 8)


@query("paired_events", "G8 G12", f"""
    WITH v AS (SELECT * FROM events WHERE event_type IN ('view', 'purchase')), r AS (SELECT *, lag(event_type) OVER {W} AS pk FROM v),
    h AS (SELECT * FROM r WHERE (pk IS NULL OR pk <> event_type) AND NOT (pk IS NULL AND event_type = 'purchase')),
    n AS (SELECT *, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER {W}::BIGINT AS pair FROM h),
    p AS (SELECT user_id, pair, min(ts) FILTER (event_type = 'view') AS a, min(ts) FILTER (event_type = 'purchase') AS b FROM n GROUP BY 1, 2)
    SELECT user_id, pair, a AS start_datetime, coalesce(b, e) AS stop_datetime, {days('a', 'coalesce(b, e)')} AS duration_days FROM p JOIN (SELECT user_id, max(ts) AS e FROM events GROUP BY 1) USING (user_id)
""")
def paired_events(t):
    rows = series.Ordered(t.events.drop("props"), KEY, [TS, *TIE]).whole(disch=("max", "ts"))
    return series.pair_events(rows, KEY, TS, TIE, "event_type", "view", "purchase", ["disch"])


@query("elapsed_from_first", "G9", f"SELECT event_id, {hours('min(ts) OVER (PARTITION BY user_id)', 'ts')} AS elapsed FROM events")
def elapsed_from_first(t):
    return series.since_first(t.events, KEY, TS, TIE).select("event_id", "elapsed")


@query("rolling_maximum", "G10", """
    SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS rolling FROM events
""")
def rolling_maximum(t):
    return series.rolling(t.events, KEY, TS, "value", 2).select("event_id", "rolling")


@query("first_sustained_control", "G11 G10", f"""
    WITH r AS (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS m, min(ts) OVER (PARTITION BY user_id) AS f FROM events)
    SELECT user_id, min(ts) AS sustained_datetime, min({hours('f', 'ts')}) AS hours_to_sustained FROM r WHERE {hours('f', 'ts')} >= 24 AND m < 20 GROUP BY 1
""")
def first_sustained_control(t):
    return series.sustained(t.events, KEY, TS, TIE, "value", 20, 24)


@query("sequence_within_type", "G12", "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events")
def sequence_within_type(t):
    return series.sequence_number(t.events, ["user_id", "event_type"], [TS, *TIE]).select("event_id", "n")


@query("series_aligned_on_time", "G14", """
    SELECT coalesce(a.o_custkey, b.o_custkey) AS person, coalesce(a.o_orderdate, b.o_orderdate) AS at, a.x AS urgent_price, b.x AS other_price FROM
    (SELECT o_custkey, o_orderdate, max(o_totalprice) AS x FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2) a FULL JOIN
    (SELECT o_custkey, o_orderdate, max(o_totalprice) AS x FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1, 2) b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate
""")
def series_aligned_on_time(t):
    def one(condition, name):
        return t.orders.filter(condition).groupBy(F.col("o_custkey").alias("person"), F.col("o_orderdate").alias("at")).agg(F.max("o_totalprice").alias(name))

    urgent = F.col("o_orderpriority") == "1-URGENT"
    return merge_full([one(urgent, "urgent_price"), one(~urgent, "other_price")], ["person", "at"])


@query("shift_days", "G15", "SELECT date_trunc('day', ts - INTERVAL 7 HOUR) AS shift_date, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def shift_days(t):
    return t.events.groupBy(shift_day("ts", 7).alias("shift_date")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("fiscal_years", "G16", "SELECT date_trunc('year', date_trunc('month', o_orderdate) + INTERVAL 6 MONTH)::TIMESTAMP AS fiscal_year, count(*) AS n FROM orders GROUP BY 1")
def fiscal_years(t):
    return t.orders.groupBy(fiscal_year("o_orderdate").alias("fiscal_year")).agg(F.count("*").alias("n"))


@query("value_drops", "K6 G10", """
    SELECT event_id, value - m AS change FROM (SELECT event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW) AS m FROM events) WHERE value - m <= -20
""")
def value_drops(t):
    from ..operators.courses import lab_change

    return lab_change(t.events, KEY, TS, "value", change_by=-20, back=2).select("event_id", "change")


@query("encounter_gaps", "G1 G9", f"""
    SELECT o_orderkey, {days('lag(o_orderdate) OVER w', 'o_orderdate')} AS since_prev, {days('first_value(o_orderdate) OVER w', 'o_orderdate')} AS since_first FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def encounter_gaps(t):
    o = series.Ordered(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).look(p=("lag", "o_orderdate")).whole(f=("min", "o_orderdate"))
    return o.result().select("o_orderkey", elapsed("p", "o_orderdate", "days").alias("since_prev"), elapsed("f", "o_orderdate", "days").alias("since_first"))
