"""Aggregates, summaries and statistics."""

from pyspark.sql import functions as F

from ..functions.scalar import elapsed, hosp_day
from ..operators import agg, reshape, series
from .registry import hours, query

FIRST = "min(ts) OVER (PARTITION BY user_id)"


def _since_first(t):
    """Events with hours since the first reading of the user."""
    return series.since_first(t.events.drop("props"), ["user_id"], "ts", ["event_id"], "hours", "hrs")


def _rounded(df, digits=6, skip=()):
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    return df.withColumns({c: F.round(c, digits) for c, k in kinds.items() if k == "double" and c not in skip})


@query("grouped_sums", "F1 F2", """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
           round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def grouped_sums(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"),
    )


@query("grouped_mean_na_aware", "F1", """
    SELECT l_suppkey, CASE WHEN count(d) = count(*) THEN round(avg(d), 6) END AS mean_strict, round(avg(d), 6) AS mean_known FROM (SELECT l_suppkey, CASE WHEN l_discount > 0.095 THEN NULL ELSE l_discount END AS d FROM lineitem) GROUP BY 1
""")
def grouped_mean_na_aware(t):
    rows = t.lineitem.select("l_suppkey", F.when(F.col("l_discount") <= 0.095, F.col("l_discount")).alias("d"))
    return rows.groupBy("l_suppkey").agg(F.round(agg.complete("d", F.avg("d")), 6).alias("mean_strict"), F.round(F.avg("d"), 6).alias("mean_known"))


@query("row_counts", "F2", "SELECT user_id, event_type, count(*) AS n_events FROM events GROUP BY 1, 2")
def row_counts(t):
    return t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n_events"))


@query("distinct_counts", "F3", """
    SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1
""")
def distinct_counts(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("n_orders"), F.count_distinct("l_partkey").alias("n_parts"))


@query("group_count_on_rows", "F4", "SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events")
def group_count_on_rows(t):
    return series.Ordered(t.events, ["user_id", "event_type"], ["ts", "event_id"]).whole(n=("count", "event_id")).result().select("event_id", "n")


@query("summary_bundle", "F5", """
    SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(quantile_cont(value, 0.25), 6) AS q25, round(median(value), 6) AS median,
           round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM events GROUP BY 1
""")
def summary_bundle(t):
    return _rounded(agg.summary_stats(t.events, ["event_type"], "value"))


@query("windowed_percentile", "F6", """
    SELECT event_id, value > q75 AS above_q75, value < med AS below_median FROM events JOIN (SELECT user_id, quantile_cont(value, 0.75) AS q75, median(value) AS med FROM events GROUP BY 1) USING (user_id)
""")
def windowed_percentile(t):
    q = agg.exact_quantiles(t.events, ["user_id"], "value", (0.5, 0.75), ("med", "q75"))
    rows = t.events.join(q, "user_id")
    return rows.select("event_id", (F.col("value") > F.col("q75")).alias("above_q75"), (F.col("value") < F.col("med")).alias("below_median"))


@query("ordered_first_last", "F7", """
    SELECT user_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY 1
""")
def ordered_first_last(t):
    place = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(
        F.min_by("value", place).alias("first_value"), F.max_by("value", place).alias("last_value"), F.max_by("event_type", place).alias("last_type")
    )


@query("flag_sums", "F8", """
    SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS n_returned, bool_or(l_linestatus = 'O') AS any_open, max(l_quantity > 45) AS any_large FROM lineitem GROUP BY 1
""")
def flag_sums(t):
    return t.lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.bool_or(F.col("l_linestatus") == "O").alias("any_open"),
        F.max(F.col("l_quantity") > 45).alias("any_large"),
    )


@query("ordered_text_list", "F9", """
    SELECT l_orderkey, string_agg(l_returnflag, '; ' ORDER BY l_linenumber, l_returnflag) AS plans FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem) GROUP BY 1
""")
def ordered_text_list(t):
    return agg.text_list(t.lineitem, ["l_orderkey"], "l_returnflag", ["l_linenumber"], "; ", "plans")


@query("two_level_aggregation", "F10", """
    SELECT o_custkey, count(*) AS n_orders, max(doses) AS max_doses, sum(total) AS total FROM (SELECT o_custkey, l_orderkey, count(*) AS doses, sum(l_quantity) AS total
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2) GROUP BY 1
""")
def two_level_aggregation(t):
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("doses"), F.sum("l_quantity").alias("total"))
    rows = per_order.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("doses").alias("max_doses"), F.sum("total").alias("total"))


@query("global_summary", "F11 F5", """
    SELECT count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(quantile_cont(value, 0.25), 6) AS q25, round(median(value), 6) AS median,
           round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM events
""")
def global_summary(t):
    return _rounded(agg.summary_stats(t.events, [], "value"))


@query("frequency_table", "F12 I6", """
    SELECT p_brand, count(*) FILTER (l_returnflag = 'A') AS n_a, count(*) FILTER (l_returnflag = 'N') AS n_n, count(*) FILTER (l_returnflag = 'R') AS n_r, count(*) AS n
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1 ORDER BY n DESC, p_brand
""")
def frequency_table(t):
    rows = t.lineitem.select("l_partkey", "l_returnflag").join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return agg.frequency_table(rows, "p_brand", "l_returnflag", ["A", "N", "R"]).orderBy(F.desc("n"), "p_brand")


@query("home_inpatient_overlap", "F13", """
    WITH x AS (SELECT o_custkey, l_suppkey, max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS a, max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS b FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
    SELECT o_custkey, count(*) AS n_items, sum(a)::BIGINT AS n_before, sum(b)::BIGINT AS n_during, sum(a * b)::BIGINT AS n_both, round(sum(a * b) / nullif(sum(a), 0), 9) AS share_continued FROM x GROUP BY 1
""")
def home_inpatient_overlap(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    status = F.col("l_linestatus")
    out = agg.overlap_of(rows, ["o_custkey"], "l_suppkey", status == "O", status == "F")
    return out.withColumn("share_continued", F.round("share_continued", 9))


@query("area_under_curve", "F14", f"""
    WITH s AS (SELECT *, lag(value) OVER w AS pv, lag(ts) OVER w AS pt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, round(coalesce(sum((value + pv) / 2 * {hours("pt", "ts")}), 0), 4) AS auc, round({hours("min(ts)", "max(ts)")}, 6) AS duration,
           round(coalesce(sum((value + pv) / 2 * {hours("pt", "ts")}), 0) / nullif({hours("min(ts)", "max(ts)")}, 0), 6) AS wt_avg FROM s GROUP BY 1
""")
def area_under_curve(t):
    out = series.auc(t.events, ["user_id"], "ts", ["event_id"], "value")
    return out.select("user_id", F.round("auc", 4).alias("auc"), F.round("duration", 6).alias("duration"), F.round("wt_avg", 6).alias("wt_avg"))


_GAPS = f"WITH g AS (SELECT *, coalesce({hours('ts', 'lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)')}, 1e0) AS d FROM events)"


@query("time_beyond_threshold", "F15 F16", _GAPS + """
    SELECT user_id, round(sum(d), 4) AS total_hours, count(*) AS n_readings, count(*) FILTER (value < 10) AS low_num, round(coalesce(sum(d) FILTER (value < 10), 0), 4) AS low_hours,
           round(coalesce(sum(d) FILTER (value < 10), 0) / sum(d) * 100, 4) AS low_pct, count(*) FILTER (value > 80) AS high_num, round(coalesce(sum(d) FILTER (value > 80), 0), 4) AS high_hours,
           round(coalesce(sum(d) FILTER (value > 80), 0) / sum(d) * 100, 4) AS high_pct FROM g GROUP BY 1
""")
def time_beyond_threshold(t):
    return _rounded(series.time_in_band(t.events, ["user_id"], "ts", ["event_id"], "value", {"low": "value < 10", "high": "value > 80"}), 4)


@query("percent_beyond_goal", "F17", """
    SELECT user_id, count(*) AS n, count(*) FILTER (value > 50) AS n_beyond, round(count(*) FILTER (value > 50) / count(*) * 100, 6) AS pct_beyond FROM events GROUP BY 1
""")
def percent_beyond_goal(t):
    return _rounded(agg.share_beyond(t.events, ["user_id"], F.col("value") > 50))


@query("daily_summaries", "F18 G13", f"""
    SELECT user_id, day, min(value) AS lo, round(median(value), 6) AS med, round(avg(value), 6) AS mean, max(value) AS hi FROM (SELECT *, CAST(floor({hours(FIRST, 'ts')} / 24) AS BIGINT) AS day FROM events) GROUP BY 1, 2
""")
def daily_summaries(t):
    rows = _since_first(t).withColumn("day", F.floor(F.col("hrs") / 24).cast("bigint"))
    return _rounded(agg.summary_stats(rows, ["user_id", "day"], "value", shares=(0, 0.5, 1), names=("lo", "med", "hi")).drop("n", "sd"))


@query("last_day_summary", "F19", f"""
    SELECT user_id, count(*) AS n, round(avg(value), 6) AS mean, round(max(value), 6) AS hi FROM (SELECT *, max(ts) OVER (PARTITION BY user_id) AS e FROM events) WHERE {hours('ts', 'e')} <= 24 GROUP BY 1
""")
def last_day_summary(t):
    rows = agg.last_hours(t.events, ["user_id"], "ts", 24, ["event_id"])
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.max("value"), 6).alias("hi"))


@query("extreme_with_time", "F20", f"""
    SELECT user_id, value AS max_value, CAST(floor((epoch_us(ts) - epoch_us(f)) / 8.64e10) AS BIGINT) AS max_day FROM (SELECT *, {FIRST} AS f FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) = 1
""")
def extreme_with_time(t):
    rows = series.Ordered(t.events, ["user_id"], ["ts", "event_id"]).whole(f=("min", "ts")).result()
    return agg.extreme_with_time(rows, ["user_id"], "ts", "value", "f", ["event_id"])


@query("max_dose_per_weight", "F21", """
    SELECT l_orderkey, max(l_quantity / coalesce(nullif(l_tax * 1000, 0), 70)) AS max_dose_per_kg FROM lineitem GROUP BY 1
""")
def max_dose_per_weight(t):
    rows = t.lineitem.withColumn("order_weight", F.nullif(F.col("l_tax") * 1000, F.lit(0.0)))
    return agg.max_per_weight(rows, ["l_orderkey"], "l_quantity", "order_weight", F.lit(70.0))


@query("change_from_baseline_mean", "F22 D9", f"""
    WITH e AS (SELECT *, {hours(FIRST, 'ts')} AS h FROM events),
    t AS (SELECT user_id, avg(value) AS top FROM (SELECT user_id, value FROM e WHERE h <= 96 QUALIFY rank() OVER (PARTITION BY user_id ORDER BY value DESC) <= 3) GROUP BY 1),
    m AS (SELECT user_id, avg(value) AS later FROM e WHERE h > 240 AND h <= 480 GROUP BY 1)
    SELECT user_id, round(top, 6) AS top_mean, round(later, 6) AS later_mean, round(1 - later / top, 6) AS pct_change, later <= top * 0.75e0 AS decreased FROM m JOIN t USING (user_id)
""")
def change_from_baseline_mean(t):
    out = agg.baseline_to_window(_since_first(t), ["user_id"], "value", F.col("hrs") <= 96, F.col("hrs").between(240, 480) & (F.col("hrs") > 240), 3)
    return _rounded(out.withColumns({
        "pct_change": 1 - F.col("later_mean") / F.col("top_mean"), "decreased": F.col("later_mean") <= F.col("top_mean") * 0.75,
    }))


@query("days_with_dose", "F23", "SELECT user_id, event_type, count(DISTINCT ts::DATE) AS n_days FROM events GROUP BY 1, 2")
def days_with_dose(t):
    return agg.days_with(t.events, ["user_id", "event_type"], "ts")


@query("rank_sum_test", "F24", """
    WITH r AS (SELECT event_type, value, count(*) FILTER (user_id % 2 = 0) AS a, count(*) AS t FROM events GROUP BY 1, 2),
    c AS (SELECT *, sum(t) OVER (PARTITION BY event_type ORDER BY value) AS upto FROM r),
    s AS (SELECT event_type, sum(a)::DOUBLE AS n1, (sum(t) - sum(a))::DOUBLE AS n2, sum(a * (upto - t + (t + 1) / 2))::DOUBLE AS rs, sum(t::DOUBLE * t * t - t) AS ties FROM c GROUP BY 1),
    u AS (SELECT event_type, n1, n2, rs - n1 * (n1 + 1) / 2 AS u, n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1))) AS v FROM s),
    t AS (SELECT *, (u - n1 * n2 / 2 - sign(u - n1 * n2 / 2) * 0.5e0) / sqrt(v) AS z, 1 / (1 + 0.2316419e0 * abs((u - n1 * n2 / 2 - sign(u - n1 * n2 / 2) * 0.5e0) / sqrt(v))) AS k FROM u)
    SELECT event_type, n1::BIGINT AS n_first, n2::BIGINT AS n_second, u, round(z, 6) AS z, round(2 * least(0.5e0, 0.3989422804014327e0 * exp(-z * z / 2) * (k * (0.31938153e0 + k * (-0.356563782e0 + k * (1.781477937e0 + k * (-1.821255978e0 + k * 1.330274429e0)))))), 6) AS p_approx FROM t
""")
def rank_sum_test(t):
    rows = t.events.withColumn("arm", F.when(F.col("user_id") % 2 == 0, "a").otherwise("b"))
    out = agg.rank_sum(rows, "arm", "a", "b", "value", ["event_type"])
    return out.select("event_type", "n_first", "n_second", "u", F.round("z", 6).alias("z"), F.round("p_approx", 6).alias("p_approx"))


@query("rank_sum_overall", "F24 F11", """
    WITH r AS (SELECT l_quantity AS value, count(*) FILTER (l_returnflag = 'A') AS a, count(*) AS t FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1),
    c AS (SELECT *, sum(t) OVER (ORDER BY value) AS upto FROM r),
    s AS (SELECT sum(a)::DOUBLE AS n1, (sum(t) - sum(a))::DOUBLE AS n2, sum(a * (upto - t + (t + 1) / 2))::DOUBLE AS rs, sum(t::DOUBLE * t * t - t) AS ties FROM c),
    u AS (SELECT n1, n2, rs - n1 * (n1 + 1) / 2 AS u, n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1))) AS v FROM s),
    t AS (SELECT *, (u - n1 * n2 / 2 - sign(u - n1 * n2 / 2) * 0.5e0) / sqrt(v) AS z, 1 / (1 + 0.2316419e0 * abs((u - n1 * n2 / 2 - sign(u - n1 * n2 / 2) * 0.5e0) / sqrt(v))) AS k FROM u)
    SELECT n1::BIGINT AS n_first, n2::BIGINT AS n_second, u, round(2 * least(0.5e0, 0.3989422804014327e0 * exp(-z * z / 2) * (k * (0.31938153e0 + k * (-0.356563782e0 + k * (1.781477937e0 + k * (-1.821255978e0 + k * 1.330274429e0)))))), 6) AS p_approx FROM t
""")
def rank_sum_overall(t):
    return agg.rank_sum(t.lineitem, "l_returnflag", "A", "R", "l_quantity").select("n_first", "n_second", "u", F.round("p_approx", 6).alias("p_approx"))


@query("five_number_summary", "F25", """
    SELECT event_type, min(value) AS low, round(quantile_cont(value, 0.25), 6) AS q25, round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS high FROM events GROUP BY 1
""")
def five_number_summary(t):
    return _rounded(agg.five_number(t.events, ["event_type"], "value"))


@query("fixed_width_histogram", "F26", "SELECT event_type, floor(value / 10) * 10 AS bin, count(*) AS n FROM events GROUP BY 1, 2")
def fixed_width_histogram(t):
    return agg.histogram(t.events, ["event_type"], "value", 10)


@query("elapsed_time_profile", "F27", f"""
    SELECT event_type, floor(h / 24) * 24 AS bin, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(median(value), 6) AS median
    FROM (SELECT *, {hours(FIRST, 'ts')} AS h FROM events) GROUP BY 1, 2
""")
def elapsed_time_profile(t):
    return _rounded(agg.profile(_since_first(t), ["event_type"], F.col("hrs"), 24, "value"))


@query("control_chart_limits", "F28", """
    WITH m AS (SELECT o_orderstatus, date_trunc('month', o_orderdate) AS mon, count(*)::DOUBLE AS x FROM orders GROUP BY 1, 2),
    r AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY o_orderstatus ORDER BY mon)) AS mr FROM m)
    SELECT o_orderstatus, round(avg(x), 6) AS centre, round(avg(mr), 6) AS mean_range, round(avg(x) - 2.66e0 * avg(mr), 6) AS lower, round(avg(x) + 2.66e0 * avg(mr), 6) AS upper FROM r GROUP BY 1
""")
def control_chart_limits(t):
    months = t.orders.groupBy("o_orderstatus", F.date_trunc("month", "o_orderdate").alias("mon")).agg(F.count("*").cast("double").alias("x"))
    return _rounded(agg.control_limits(months, ["o_orderstatus"], ["mon"], "x"))


@query("statistics_by_measure", "I8 F5", """
    SELECT measure, round(avg(value), 6) AS mean, min(value) AS lo, max(value) AS hi, round(median(value), 6) AS med FROM (SELECT l_quantity, l_discount, l_tax FROM lineitem) UNPIVOT (value FOR measure IN (l_quantity, l_discount, l_tax)) GROUP BY 1
""")
def statistics_by_measure(t):
    aggs = {"mean": "avg(value)", "lo": "min(value)", "hi": "max(value)"}
    return _rounded(reshape.statistics_table(t.lineitem, ["l_quantity", "l_discount", "l_tax"], aggs, {"med": 0.5}))


@query("days_to_extreme_gap", "F20 J7", f"""
    SELECT user_id, round({hours('arg_min(ts, (value, ts, event_id))', 'arg_max(ts, (value, ts, event_id))')}, 6) AS hours_low_to_high FROM events GROUP BY 1
""")
def days_to_extreme_gap(t):
    place = F.struct("value", "ts", "event_id")
    return t.events.groupBy("user_id").agg(F.round(elapsed(F.min_by("ts", place), F.max_by("ts", place), "hours"), 6).alias("hours_low_to_high"))


@query("hospital_day_modes", "G13", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CAST(floor(d) AS BIGINT) AS day_floor, CAST(ceil(d) AS BIGINT) AS day_ceil, CAST(trunc(d) AS BIGINT) AS day_trunc,
           date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS day_calendar, CAST(greatest(floor(d), 0) AS BIGINT) + 1 AS day_from_one
    FROM (SELECT *, (epoch_us(l_shipdate + INTERVAL 7 HOUR) - epoch_us(o_orderdate)) / 8.64e10 AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
""")
def hospital_day_modes(t):
    from ..functions.scalar import offset

    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("at", offset("l_shipdate", 7))
    modes = {f"day_{m}": hosp_day("at", "o_orderdate", m) for m in ("floor", "ceil", "trunc", "calendar")}
    modes["day_from_one"] = hosp_day("at", "o_orderdate", "floor", clip=0, base=1)
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), *[c.alias(n) for n, c in modes.items()])
