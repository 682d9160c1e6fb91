"""Projection, filters and scalar functions."""

import datetime as dt

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalar as S
from ..operators.joins import decode_codes, restrict_to
from .registry import days, hours, query

AS_OF = dt.datetime(1998, 3, 18, 15, 30, tzinfo=dt.timezone.utc)


# ------------------------------------------------------------------ projection

@query("select_rename_reorder", "B1 B3", """
    SELECT o_custkey AS person_id, o_orderkey AS encntr_id, o_orderdate AS admit_datetime, o_totalprice AS charges FROM orders
""")
def select_rename_reorder(t):
    names = {"o_orderkey": "encntr_id", "o_custkey": "person_id", "o_orderdate": "admit_datetime", "o_totalprice": "charges"}
    out = t.orders.drop("o_orderstatus", "o_orderpriority").withColumnsRenamed(names)
    first = ["person_id"]
    return out.select(*first, *[c for c in out.columns if c not in first])


@query("select_by_pattern", "B2", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_tax FROM lineitem
""")
def select_by_pattern(t):
    names = [*S.columns_like(t.lineitem, ends="key"), *S.columns_like(t.lineitem, contains="date"), *S.columns_like(t.lineitem, matches="_t")]
    return t.lineitem.select(*names)


@query("rename_all_columns", "B3", """
    SELECT c_custkey AS custkey, c_name AS name, c_nationkey::BIGINT AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer
""")
def rename_all_columns(t):
    return S.rename_all(t.customer.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint")), lambda c: c.removeprefix("c_").upper().lower())


@query("computed_columns", "B4 J7", f"""
    SELECT event_id, user_id, round(value * 1.5e0, 6) AS scaled, round({hours("date_trunc('day', ts)", "ts")}, 6) AS hour_of_day,
           value < 50 AS below_goal FROM events
""")
def computed_columns(t):
    return t.events.select(
        "event_id", "user_id", F.round(F.col("value") * 1.5, 6).alias("scaled"),
        F.round(S.elapsed(F.date_trunc("day", "ts"), F.col("ts")), 6).alias("hour_of_day"), (F.col("value") < 50).alias("below_goal"),
    )


@query("across_columns", "B5", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(l_discount * 100, 4) AS l_discount_pct, round(l_tax * 100, 4) AS l_tax_pct FROM lineitem
""")
def across_columns(t):
    pct = S.across(["l_discount", "l_tax"], lambda c: F.round(c * 100, 4), "{col}_pct")
    return t.lineitem.withColumns(pct).select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), *pct)


@query("across_aggregates", "B5 F1", """
    SELECT l_returnflag, min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, min(l_tax) AS l_tax_min, max(l_tax) AS l_tax_max
    FROM lineitem GROUP BY l_returnflag
""")
def across_aggregates(t):
    return t.lineitem.groupBy("l_returnflag").agg(*S.across_aggs(["l_quantity", "l_tax"], {"min": F.min, "max": F.max}))


@query("multi_branch_classify", "B6", """
    SELECT o_orderkey, CASE WHEN regexp_matches(o_orderpriority, '^1|^2') THEN 'emergent' WHEN regexp_matches(o_orderpriority, 'MED') THEN 'urgent'
           ELSE 'elective' END AS admit_group,
           CASE WHEN o_totalprice < 1000 THEN 'low' WHEN o_totalprice < 200000 THEN 'mid' ELSE 'high' END AS charge_group FROM orders
""")
def multi_branch_classify(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", S.classify("o_orderpriority", {"emergent": "^1|^2", "urgent": "MED"}, "elective").alias("admit_group"),
        F.when(price < 1000, "low").when(price < 200000, "mid").otherwise("high").alias("charge_group"),
    )


@query("decode_chain", "B7", """
    SELECT c_custkey, CASE WHEN seg IS NULL THEN 'unknown' WHEN seg = 'BUILDING' THEN 'b' WHEN seg = 'MACHINERY' THEN 'm' ELSE 'other' END AS code
    FROM (SELECT c_custkey, nullif(c_mktsegment, 'FURNITURE') AS seg FROM customer)
""")
def decode_chain(t):
    seg = S.null_if("c_mktsegment", "FURNITURE")
    return t.customer.select("c_custkey", S.decode(seg, {None: "unknown", "BUILDING": "b", "MACHINERY": "m"}, "other").alias("code"))


@query("missing_aware_if", "B8", """
    SELECT c_custkey, CASE WHEN seg IS NULL THEN 'missing' WHEN seg = 'BUILDING' THEN 'yes' ELSE 'no' END AS building
    FROM (SELECT c_custkey, nullif(c_mktsegment, 'FURNITURE') AS seg FROM customer)
""")
def missing_aware_if(t):
    hit = S.null_if("c_mktsegment", "FURNITURE") == "BUILDING"
    return t.customer.select("c_custkey", S.if_missing_aware(hit, F.lit("yes"), F.lit("no"), F.lit("missing")).alias("building"))


@query("fill_absent_flags", "B9", """
    SELECT c_custkey, coalesce(max(o_orderstatus = 'F'), FALSE) AS has_final, coalesce(max(o_totalprice > 400000), FALSE) AS has_high
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
""")
def fill_absent_flags(t):
    flags = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.col("o_orderstatus") == "F").alias("has_final"), F.max(F.col("o_totalprice") > 400000).alias("has_high")
    )
    return S.fill_flags(t.customer.select("c_custkey").join(flags, "c_custkey", "left"))


@query("null_out_sentinel", "B10 J10", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, nullif(l_discount, 0) AS l_discount, coalesce(nullif(l_tax, 0), l_discount) AS tax_or_discount FROM lineitem
""")
def null_out_sentinel(t):
    return t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), S.null_if("l_discount", 0.0).alias("l_discount"),
        F.coalesce(S.null_if("l_tax", 0.0), "l_discount").alias("tax_or_discount"),
    )


@query("rowwise_minimum", "B11 B12", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, least(d, x, l_quantity) AS least_known,
           CASE WHEN d IS NULL OR x IS NULL THEN NULL ELSE least(d, x) END AS least_strict
    FROM (SELECT *, nullif(l_discount, 0) AS d, nullif(l_tax, 0) AS x FROM lineitem)
""")
def rowwise_minimum(t):
    rows = t.lineitem.withColumns({"d": S.null_if("l_discount", 0.0), "x": S.null_if("l_tax", 0.0)})
    return rows.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        S.least_known("d", "x", "l_quantity").alias("least_known"), S.least_strict("d", "x").alias("least_strict"),
    )


@query("distinct_projection", "B13", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_projection(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query("code_to_display", "B14 E20", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, cn.n_name AS person_nation, sn.n_name AS supplier_nation
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey
""")
def code_to_display(t):
    rows = (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    )
    named = decode_codes(rows, t.nation, "n_nationkey", "n_name", {"c_nationkey": "person_nation", "s_nationkey": "supplier_nation"})
    return named.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "person_nation", "supplier_nation")


@query("constant_flag_columns", "B15", """
    SELECT DISTINCT l_orderkey, TRUE AS exposed, 'lineitem' AS source FROM lineitem WHERE l_returnflag = 'R'
""")
def constant_flag_columns(t):
    keys = t.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey").distinct()
    return keys.withColumns({"exposed": F.lit(True), "source": F.lit("lineitem")})


# --------------------------------------------------------------------- filters

@query("filter_comparison", "C1", """
    SELECT event_id, user_id, value FROM events WHERE value >= 20 AND value < 90 AND ts > TIMESTAMP '2024-01-10' AND event_type <> 'error'
""")
def filter_comparison(t):
    late = F.col("ts") > F.lit("2024-01-10").cast("timestamp")
    return t.events.filter((F.col("value") >= 20) & (F.col("value") < 90) & late & (F.col("event_type") != "error")).select("event_id", "user_id", "value")


@query("filter_code_lists", "C2", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey FROM lineitem
    WHERE l_suppkey IN (SELECT unnest(range(3, 300, 4))) AND l_linenumber NOT IN (2, 5)
""")
def filter_code_lists(t):
    rows = P.in_codes(t.lineitem, "l_suppkey", range(3, 300, 4))
    rows = P.in_codes(rows, "l_linenumber", [2, 5], keep=False)
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_suppkey")


@query("filter_between", "C3", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-06-30 23:59:59'
""")
def filter_between(t):
    bounds = (dt.datetime(1997, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(1998, 6, 30, 23, 59, 59, tzinfo=dt.timezone.utc))
    return t.orders.filter(P.in_range("o_orderdate", bounds)).select("o_orderkey", "o_orderdate")


@query("filter_regex", "C4 C5", """
    SELECT p_partkey, p_name, p_type FROM part WHERE regexp_matches(p_name, 'r.d|widget$') AND regexp_matches(p_type, '(?i)^(eco|promo)')
""")
def filter_regex(t):
    return t.part.filter(F.col("p_name").rlike("r.d|widget$") & F.col("p_type").rlike("(?i)^(eco|promo)")).select("p_partkey", "p_name", "p_type")


@query("filter_null_tests", "C6 E2", """
    SELECT c_custkey, n_final FROM customer LEFT JOIN (SELECT o_custkey, count(*)::DOUBLE AS n_final FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    ON o_custkey = c_custkey WHERE n_final IS NULL OR c_acctbal IS NOT NULL AND n_final > 4
""")
def filter_null_tests(t):
    finals = t.orders.filter(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").cast("double").alias("n_final"))
    rows = t.customer.join(finals, "c_custkey", "left")
    return rows.filter(F.col("n_final").isNull() | (F.col("c_acctbal").isNotNull() & (F.col("n_final") > 4))).select("c_custkey", "n_final")


@query("filter_or_of_ands", "C7", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem
    WHERE (l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 40) OR (l_returnflag IN ('A', 'N') AND l_quantity <= 5)
""")
def filter_or_of_ands(t):
    hit = P.any_of(
        {"l_returnflag": "R", "l_linestatus": "O", "l_quantity": lambda c: c > 40}, {"l_returnflag": ["A", "N"], "l_quantity": lambda c: c <= 5}
    )
    return t.lineitem.filter(hit).select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_returnflag", "l_linestatus", "l_quantity")


_RESULT_TEXT = """CASE WHEN event_type = 'error' THEN 'See Note' WHEN event_type = 'view' THEN '<' || value::VARCHAR
    WHEN event_type = 'signup' THEN '>' || value::VARCHAR ELSE value::VARCHAR END"""


def result_text():
    """Result texts as a laboratory would send them: censored, free text, or a number."""
    v = F.col("value").cast("string")
    kind = F.col("event_type")
    return F.when(kind == "error", "See Note").when(kind == "view", F.concat(F.lit("<"), v)).when(kind == "signup", F.concat(F.lit(">"), v)).otherwise(v)


@query("drop_text_results", "C8", f"""
    SELECT event_id, {_RESULT_TEXT} AS result_val FROM events WHERE NOT regexp_matches({_RESULT_TEXT}, '[A-Za-z]')
""")
def drop_text_results(t):
    return t.events.select("event_id", result_text().alias("result_val")).filter(S.is_numeric_text("result_val"))


@query("plausible_band", "C9", "SELECT event_id, value FROM events WHERE value > 5 AND value < 100")
def plausible_band(t):
    return t.events.filter(P.plausible("value", 5, 100)).select("event_id", "value")


@query("current_version_rows", "C10", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate FROM lineitem
    WHERE (CASE WHEN l_linestatus = 'O' THEN TIMESTAMP '2100-12-31' ELSE l_shipdate END) > TIMESTAMP '2099-12-31'
      AND (CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) = 1 AND l_shipdate > TIMESTAMP '1998-03-18 15:30:00'
""")
def current_version_rows(t):
    rows = t.lineitem.withColumns({
        "valid_until": F.when(F.col("l_linestatus") == "O", F.lit("2100-12-31").cast("timestamp")).otherwise(F.col("l_shipdate")),
        "active": F.when(F.col("l_returnflag") == "R", 0).otherwise(1),
    })
    rows = rows.filter(P.current_version("valid_until", "active", "l_shipdate", AS_OF))
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_shipdate")


@query("relative_date_presets", "C11", """
    WITH r(preset, lo, hi) AS (VALUES
      ('Today', TIMESTAMPTZ '1998-03-18 06:00:00+00', TIMESTAMPTZ '1998-03-19 05:59:59+00'),
      ('Yesterday', TIMESTAMPTZ '1998-03-17 06:00:00+00', TIMESTAMPTZ '1998-03-18 05:59:59+00'),
      ('Week to Date', TIMESTAMPTZ '1998-03-15 06:00:00+00', TIMESTAMPTZ '1998-03-18 05:59:59+00'),
      ('Last Week', TIMESTAMPTZ '1998-03-08 06:00:00+00', TIMESTAMPTZ '1998-03-15 05:59:59+00'),
      ('Last Month', TIMESTAMPTZ '1998-02-01 06:00:00+00', TIMESTAMPTZ '1998-03-01 05:59:59+00'),
      ('Month to Date', TIMESTAMPTZ '1998-03-01 06:00:00+00', TIMESTAMPTZ '1998-03-18 05:59:59+00'),
      ('User-defined', TIMESTAMPTZ '1997-07-01 05:00:00+00', TIMESTAMPTZ '1997-12-31 06:00:00+00'),
      ('N Days Prior', TIMESTAMPTZ '1998-02-16 15:30:00+00', TIMESTAMPTZ '1998-03-18 15:30:00+00'))
    SELECT preset, count(o_orderkey) AS n, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date
    FROM r LEFT JOIN orders ON o_orderdate BETWEEN lo AT TIME ZONE 'UTC' AND hi AT TIME ZONE 'UTC' GROUP BY preset
""")
def relative_date_presets(t):
    aggs = []
    spans = {
        p: P.date_range(p, AS_OF, "America/Chicago", lo=dt.datetime(1997, 7, 1), hi=dt.datetime(1997, 12, 31), days=30) for p in P.PRESETS
    }
    low, high = min(s[0] for s in spans.values()), max(s[1] for s in spans.values())
    for i, span in enumerate(spans.values()):
        hit = P.in_range("o_orderdate", span)
        aggs += [F.count_if(hit).alias(f"n{i}"), F.min(F.when(hit, F.col("o_orderdate"))).alias(f"lo{i}"), F.max(F.when(hit, F.col("o_orderdate"))).alias(f"hi{i}")]
    one = t.orders.filter(P.in_range("o_orderdate", (low, high))).agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(p).alias("preset"), F.col(f"n{i}").alias("n"), F.col(f"lo{i}").alias("first_date"), F.col(f"hi{i}").alias("last_date"))
        for i, p in enumerate(spans)
    ])))


@query("adult_at_admission", "C12", """
    SELECT o_orderkey, CAST(floor(date_diff('day', birth::DATE, o_orderdate::DATE) / 365.25e0) AS BIGINT) AS age
    FROM (SELECT *, TIMESTAMP '1975-01-01' + to_days(CAST((o_custkey * 37) % 9000 AS INTEGER)) AS birth FROM orders)
    WHERE floor(date_diff('day', birth::DATE, o_orderdate::DATE) / 365.25e0) >= 18
""")
def adult_at_admission(t):
    birth = F.date_add(F.lit("1975-01-01").cast("date"), (F.col("o_custkey") * 37 % 9000).cast("int"))
    rows = t.orders.withColumn("birth", birth).filter(P.adult("birth", "o_orderdate"))
    return rows.select("o_orderkey", S.age_years("birth", "o_orderdate").alias("age"))


@query("window_around_anchor", "C13", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 48 HOUR AND o_orderdate + INTERVAL 720 HOUR
""")
def window_around_anchor(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).filter(P.around("l_shipdate", "o_orderdate", 48, 720))
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_shipdate", "o_orderdate")


@query("filter_after_left_join", "C14", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'O'
    WHERE l_shipdate > o_orderdate
""")
def filter_after_left_join(t):
    open_orders = t.orders.filter(F.col("o_orderstatus") == "O").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = t.lineitem.join(open_orders, "l_orderkey", "left").filter(F.col("l_shipdate") > F.col("o_orderdate"))
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))


# --------------------------------------------------------------------- scalars

@query("text_functions", "J1", """
    SELECT c_custkey, lower(c_name) AS lower_name, length(c_mktsegment) AS n, substring(c_name, 1, 4) AS head, right(c_name, 3) AS tail,
           lpad(c_custkey::VARCHAR, 8, '0') AS padded, c_name || '/' || c_mktsegment AS joined FROM customer
""")
def text_functions(t):
    return t.customer.select(
        "c_custkey", F.lower("c_name").alias("lower_name"), F.length("c_mktsegment").cast("bigint").alias("n"), F.substring("c_name", 1, 4).alias("head"),
        F.right("c_name", F.lit(3)).alias("tail"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"),
        F.concat_ws("/", "c_name", "c_mktsegment").alias("joined"),
    )


@query("regex_functions", "J2", """
    SELECT p_partkey, regexp_replace(regexp_replace(p_name, 'small', 'sm', 'g'), ' ', '_', 'g') AS short_name,
           regexp_extract(p_brand, '[0-9]+') AS brand_no, trim(regexp_replace(p_name, 'red|blue', '', 'g')) AS plain FROM part
""")
def regex_functions(t):
    return t.part.select(
        "p_partkey", S.replace_each("p_name", {"small": "sm", " ": "_"}).alias("short_name"),
        F.regexp_extract("p_brand", "[0-9]+", 0).alias("brand_no"), S.remove_words("p_name", ["red", "blue"]).alias("plain"),
    )


@query("format_and_parse_time", "J3", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, date_trunc('minute', ts) AS parsed, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS parsed_or_null FROM events
""")
def format_and_parse_time(t):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
    return t.events.select(
        "event_id", S.iso_text("ts").alias("iso"), S.parse_time(F.date_format("ts", "yyyy-MM-dd HH:mm"), "yyyy-MM-dd HH:mm").alias("parsed"),
        S.parse_time(text, "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss").alias("parsed_or_null"),
    )


@query("zone_conversion", "J4", """
    SELECT o_orderkey, timezone('America/Chicago', timezone('UTC', o_orderdate)) AS local_time, timezone('UTC', timezone('America/Chicago', o_orderdate)) AS utc_time FROM orders
""")
def zone_conversion(t):
    return t.orders.select("o_orderkey", S.to_local("o_orderdate", "America/Chicago").alias("local_time"), S.to_utc("o_orderdate", "America/Chicago").alias("utc_time"))


@query("truncate_time", "J5", """
    SELECT event_id, date_trunc('hour', ts) AS hr, date_trunc('day', ts) AS dy, date_trunc('month', ts) AS mon, date_trunc('year', ts) AS yr,
           date_trunc('month', ts) - INTERVAL 1 MONTH AS prior_month, last_day(ts)::TIMESTAMP AS month_end FROM events
""")
def truncate_time(t):
    month = F.date_trunc("month", "ts")
    return t.events.select(
        "event_id", F.date_trunc("hour", "ts").alias("hr"), F.date_trunc("day", "ts").alias("dy"), month.alias("mon"), F.date_trunc("year", "ts").alias("yr"),
        F.add_months(month, -1).cast("timestamp").alias("prior_month"), F.last_day("ts").cast("timestamp").alias("month_end"),
    )


@query("time_offsets", "J6", """
    SELECT o_orderkey, o_orderdate + INTERVAL 3 HOUR AS plus_eighth, o_orderdate - INTERVAL 1 SECOND AS minus_second,
           o_orderdate + INTERVAL 3 MONTH AS plus_months FROM orders
""")
def time_offsets(t):
    return t.orders.select(
        "o_orderkey", S.offset("o_orderdate", 1 / 8, "days").alias("plus_eighth"), S.offset("o_orderdate", -1, "seconds").alias("minus_second"),
        F.add_months("o_orderdate", 3).cast("timestamp").alias("plus_months"),
    )


@query("elapsed_units", "J7", f"""
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {hours("o_orderdate", "l_shipdate")} AS h, {days("o_orderdate", "l_shipdate")} AS d,
           (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 6e7 AS m FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def elapsed_units(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    spans = {n: S.elapsed("o_orderdate", "l_shipdate", u) for n, u in {"h": "hours", "d": "days", "m": "minutes"}.items()}
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), *[c.alias(n) for n, c in spans.items()])


@query("numeric_functions", "J8", """
    SELECT event_id, abs(value - 50) AS dist, round(value, 1) AS r1, round_even(value, 0) AS half_even, CAST(floor(value) AS BIGINT) AS fl,
           CAST(ceil(value) AS BIGINT) AS ce, CAST(trunc(value - 50) AS BIGINT) AS tr FROM events
""")
def numeric_functions(t):
    v = F.col("value")
    return t.events.select(
        "event_id", F.abs(v - 50).alias("dist"), F.round(v, 1).alias("r1"), F.bround(v, 0).alias("half_even"), F.floor(v).alias("fl"), F.ceil(v).alias("ce"),
        (v - 50).cast("bigint").alias("tr"),
    )


@query("safe_casts", "J9", f"""
    SELECT event_id, try_cast({_RESULT_TEXT} AS DOUBLE) AS number, event_id::VARCHAR AS id_text, value > 0 AS flag FROM events
""")
def safe_casts(t):
    return t.events.select(
        "event_id", result_text().try_cast("double").alias("number"), F.col("event_id").cast("string").alias("id_text"), (F.col("value") > 0).alias("flag")
    )


# -------------------------------------------------- cleaning of clinical fields

@query("parse_result_text", "K1", f"""
    WITH r AS (SELECT event_id, {_RESULT_TEXT} AS result_val FROM events)
    SELECT event_id, try_cast(regexp_replace(result_val, '[<>,]', '', 'g') AS DOUBLE) AS value,
           contains(result_val, '<') AS censor_low, contains(result_val, '>') AS censor_high FROM r
""")
def parse_result_text(t):
    return t.events.select("event_id", S.parse_result(result_text()).alias("p")).select("event_id", "p.*")


@query("normalized_rates", "K14", """
    WITH r AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, 50 + l_suppkey % 50 AS weight,
             CASE l_linenumber WHEN 1 THEN 'mg/hr' WHEN 2 THEN 'microgram/min' WHEN 3 THEN 'mg/kg/hr' WHEN 4 THEN 'microgram/kg/min' WHEN 5 THEN 'mg/min' ELSE NULL END AS unit,
             CASE WHEN l_linenumber > 5 THEN NULL ELSE l_quantity END AS rate, l_extendedprice AS dose, CASE WHEN l_returnflag = 'R' THEN 'mL' ELSE 'mg' END AS dose_unit
      FROM lineitem)
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, round(CASE unit
             WHEN 'mg/hr' THEN rate * (1000e0 / 60) / weight WHEN 'microgram/min' THEN rate / weight WHEN 'mg/kg/hr' THEN rate * (1000e0 / 60)
             WHEN 'microgram/kg/min' THEN rate WHEN 'mg/min' THEN rate * 1000e0 / weight
             ELSE CASE WHEN dose_unit = 'mL' THEN dose * 0.75e0 / 100e0 ELSE dose END * ((1000e0 / 60) / weight) END, 8) AS rate_adj FROM r
""")
def normalized_rates(t):
    n = F.col("l_linenumber")
    units = ["mg/hr", "microgram/min", "mg/kg/hr", "microgram/kg/min", "mg/min"]
    rows = t.lineitem.withColumns({
        "weight": 50 + F.col("l_suppkey") % 50, "unit": S.decode(n, dict(enumerate(units, 1))), "rate": F.when(n <= 5, F.col("l_quantity")),
        "dose_unit": F.when(F.col("l_returnflag") == "R", "mL").otherwise("mg"),
    })
    adj = S.normalize_rate("rate", "unit", "weight", "l_extendedprice", "dose_unit", F.lit(0.75), F.lit(100.0))
    return rows.select("l_orderkey", n.cast("bigint").alias("l_linenumber"), "l_partkey", F.round(adj, 8).alias("rate_adj"))


_RATE_TEXTS = {
    0: ("Titrate as directed, run at ", " mL/hr"), 1: ("Infusion rate - ", " cc/hr"), 2: ("", " ml per hour over 24 hours"), 3: ("continue at 2.25 mcg/kg/min", None),
    4: ("see comments ", " Micrograms/kg/min"), 5: ("per protocol", None), 6: (None, None), 7: ("for 6-hours. ", "0 ml/h"), 8: ("", " units/hr"),
}


def _rate_text(n, quantity):
    """A typed rate by row: known and unknown units, phrases without a rate, and none."""
    out = None
    for case, (before, after) in _RATE_TEXTS.items():
        text = F.lit(before) if after is None else F.concat(F.lit(before), quantity, F.lit(after))
        out = (F if out is None else out).when(n % 9 == case, text)
    return out


_RATE_SQL = " ".join(
    f"WHEN {case} THEN " + ("NULL" if before is None else f"'{before}'" if after is None else f"'{before}' || l_quantity::INT || '{after}'") for case, (before, after) in _RATE_TEXTS.items()
)


@query("free_text_rates", "K14", rf"""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, 50 + l_suppkey % 50 AS weight, CASE WHEN l_returnflag = 'A' THEN NULL ELSE 100 + l_partkey % 3 END AS concentration,
      CASE (l_orderkey + l_linenumber) % 9 {_RATE_SQL} END AS freetext FROM lineitem),
    p AS (SELECT *, regexp_replace(lower(freetext), 'titrate|see comments|as directed|continue at|for 6-hours.|over 24 hours|run at|infusion rate -', '', 'g') AS plain FROM r),
    u AS (SELECT *, try_cast(regexp_extract(plain, '[0-9]\.?[0-9]{{0,2}}') AS DOUBLE) AS free_rate, nullif(regexp_extract(plain, 'microgram[s]?/kg/min|mcg/kg/min|ml/h[r]?|cc/hr|ml per hour|ml/hour'), '') AS unit FROM p),
    n AS (SELECT *, CASE WHEN unit IN ('ml/h', 'cc/hr', 'ml per hour', 'ml/hour') THEN 'ml/hr' WHEN unit IN ('micrograms/kg/min', 'mcg/kg/min') THEN 'microgram/kg/min' ELSE unit END AS free_unit FROM u)
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, free_rate, free_unit, round(CASE free_unit WHEN 'ml/hr' THEN free_rate * (coalesce(concentration, 75) / 250e0) * (1000e0 / 60) / weight
      WHEN 'microgram/kg/min' THEN free_rate END, 8) AS rate_adj FROM n
""")
def free_text_rates(t):
    text = _rate_text(F.col("l_orderkey") + F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string"))
    rows = t.lineitem.withColumns({"freetext": text, "weight": 50 + F.col("l_suppkey") % 50, "concentration": F.when(F.col("l_returnflag") != "A", 100 + F.col("l_partkey") % 3), "volume": F.lit(250.0)})
    read = S.free_text_rate("freetext")
    return rows.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", read["rate"].alias("free_rate"), read["unit"].alias("free_unit"),
        F.round(S.free_text_to_weight_rate("freetext", "weight", "concentration", "volume"), 8).alias("rate_adj"),
    )


@query("canonical_medication", "K15", """
    WITH m AS (SELECT p_partkey, trim(regexp_replace(lower(p_name || ' HCl in Dextrose'), 'dextrose| in|sodium chloride|water for injection sterile|nacl|hcl|d5w', '', 'g')) AS plain FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(plain, 'widget') THEN 'widget' WHEN regexp_matches(plain, 'get|ring') THEN 'ring' ELSE plain END AS medication FROM m
""")
def canonical_medication(t):
    name = F.concat("p_name", F.lit(" HCl in Dextrose"))
    return t.part.select("p_partkey", S.canonical_med(name, {"widget": "widget", "ring": "get|ring"}).alias("medication"))


@query("route_groups", "K16", """
    SELECT r, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(route, 'IV') THEN 'iv' WHEN regexp_matches(route, '^(PO|GT|NJ|NG|DHT|OGT|T FEED|PEG)$') THEN 'po'
      WHEN regexp_matches(route, 'SUB-?Q|SUBCUT') THEN 'subq' ELSE 'other' END AS r FROM (
        SELECT CASE l_returnflag WHEN 'A' THEN 'IVPB' WHEN 'N' THEN CASE WHEN l_linestatus = 'O' THEN 'PEG' ELSE 'SUB-Q' END ELSE CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'NEB' END END AS route FROM lineitem))
    GROUP BY r
""")
def route_groups(t):
    is_open = F.col("l_linestatus") == "O"
    route = F.when(F.col("l_returnflag") == "A", "IVPB").when(F.col("l_returnflag") == "N", F.when(is_open, "PEG").otherwise("SUB-Q")).otherwise(F.when(is_open, None).otherwise("NEB"))
    return t.lineitem.groupBy(S.route_group(route).alias("r")).agg(F.count("*").alias("n"))


@query("repaired_account_ids", "K23", """
    WITH a AS (SELECT l_orderkey, l_linenumber, lpad(l_orderkey::VARCHAR, 8, '0') || CASE WHEN l_linestatus = 'O' THEN l_linenumber::VARCHAR ELSE lpad(l_linenumber::VARCHAR, 4, '0') END AS fin FROM lineitem)
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, lpad(l_orderkey::VARCHAR, 8, '0') || lpad(l_linenumber::VARCHAR, 4, '0') AS fin FROM a
""")
def repaired_account_ids(t):
    n = F.col("l_linenumber").cast("string")
    fin = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 8, "0"), F.when(F.col("l_linestatus") == "O", n).otherwise(F.lpad(n, 4, "0")))
    return t.lineitem.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), S.repair_account_id(fin).alias("fin"))


@query("drop_listed_ids", "C2 E7", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def drop_listed_ids(t):
    ids = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return restrict_to(t.orders, ids, "o_custkey", keep=False).select("o_orderkey", "o_custkey")
