"""Composite clinical features, and the flagship report."""

from pyspark.sql import functions as F

from ..functions.predicates import adult
from ..functions.scalar import decode, elapsed, fill_flags, hosp_day
from ..operators import cohort, courses, features, joins, pick, series
from .registry import days, hours, query

W = "(PARTITION BY user_id ORDER BY ts, event_id)"
KEY, TS, TIE = ["user_id"], "ts", ["event_id"]
TYPES = ["click", "error", "purchase", "signup", "view"]


def _rounded(df, digits=6, skip=()):
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    return df.withColumns({c: F.round(c, digits) for c, k in kinds.items() if k == "double" and c not in skip})


def _dx(t):
    """Diagnosis rows: one per line item, coded by the part's brand and type."""
    code = F.concat_ws(".", F.regexp_replace("p_brand", "Brand#", "I"), F.col("p_size").cast("string"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), code.alias("code"), "p_type")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus").join(parts, "l_partkey")


_DX = """dx AS (SELECT l_orderkey, l_linenumber, l_linestatus, p_type, replace(p_brand, 'Brand#', 'I') || '.' || p_size::VARCHAR AS code FROM lineitem JOIN part ON p_partkey = l_partkey)"""
_ICD = {"htn": r"^I1\.|^I10\.", "cva": r"^I2.\.", "dm": r"^I[34]", "ckd": r"\.1.$"}
_ICD_CASE = "CASE " + " ".join(f"WHEN regexp_matches(code, '{p}') THEN '{n}'" for n, p in _ICD.items()) + " END"


@query("dose_courses", "K2", f"""
    WITH d AS (SELECT o_custkey, l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    g AS (SELECT *, CASE WHEN {hours('lag(l_shipdate) OVER w', 'l_shipdate')} <= 1440 THEN 0 ELSE 1 END AS n FROM d WINDOW w AS (PARTITION BY o_custkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)),
    c AS (SELECT *, sum(n) OVER (PARTITION BY o_custkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING)::BIGINT AS course_count FROM g)
    SELECT o_custkey, l_returnflag, course_count, min(l_shipdate) AS dose_start, max(l_shipdate) AS dose_stop, count(*) AS num_doses, {hours('min(l_shipdate)', 'max(l_shipdate)')} AS duration,
           arg_min(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)) AS first_dose, arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)) AS last_dose,
           max(l_quantity) AS max_dose, round(avg(l_quantity), 6) AS avg_dose FROM c GROUP BY 1, 2, 3
""")
def dose_courses(t):
    persons = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rows = t.lineitem.join(persons, "l_orderkey")
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    out = courses.med_runtime(rows, ["o_custkey", "l_returnflag"], "l_shipdate", "l_quantity", tie, gap_hours=1440)
    return out.withColumn("avg_dose", F.round("avg_dose", 6))


_DRIP = f"""
    r AS (SELECT *, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN 0 ELSE value END AS rate FROM events),
    g AS (SELECT *, CASE WHEN {hours(f'lag(ts) OVER {W}', 'ts')} <= 12 THEN 0 ELSE 1 END AS n FROM r),
    c AS (SELECT *, sum(n) OVER {W}::BIGINT AS drip_count FROM g),
    f AS (SELECT *, last_value(rate IGNORE NULLS) OVER (PARTITION BY user_id, drip_count ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS rate_filled,
                 min(ts) OVER (PARTITION BY user_id, drip_count) AS drip_start, max(ts) OVER (PARTITION BY user_id, drip_count) AS drip_stop,
                 lead(ts) OVER (PARTITION BY user_id, drip_count ORDER BY ts, event_id) AS nt FROM c),
    x AS (SELECT *, {hours('drip_start', 'ts')} AS run_time, coalesce({hours('ts', 'nt')}, 0e0) AS duration FROM f)"""


def _drips(t):
    kind = F.col("event_type")
    rate = F.when(kind == "error", None).when(kind == "signup", 0.0).otherwise(F.col("value"))
    return courses.drip_runtime(t.events.drop("props").withColumn("rate", rate), KEY, TS, "rate", TIE, drip_off=12)


@query("infusion_rows", "K3", f"WITH {_DRIP} SELECT event_id, drip_count, drip_start, drip_stop, rate_filled, run_time, duration FROM x")
def infusion_rows(t):
    return _drips(t).select("event_id", "drip_count", "drip_start", "drip_stop", "rate_filled", "run_time", "duration")


@query("infusion_summary", "K4", f"""
    WITH {_DRIP}
    SELECT user_id, drip_count, min(ts) AS start_datetime, max(ts) AS stop_datetime, {hours('min(ts)', 'max(ts)')} AS duration, arg_min(rate_filled, (ts, event_id)) FILTER (rate IS NOT NULL) AS first_rate,
           arg_max(rate_filled, (ts, event_id)) AS last_rate, max(rate_filled) AS max_rate, round(sum(rate_filled * duration) / nullif(sum(duration) , 0), 6) AS time_wt_avg_rate,
           round(coalesce(sum(duration) FILTER (rate_filled > 0), 0), 6) AS infusion_run_time FROM x WHERE rate IS NOT NULL GROUP BY 1, 2
""")
def infusion_summary(t):
    known = _drips(t).filter(F.col("rate").isNotNull())
    return _rounded(courses.summarize_drips(known, KEY, TS, TIE), skip=("duration",))


@query("series_day_summary", "K5 G13", f"""
    WITH d AS (SELECT *, CAST(floor({hours('min(ts) OVER (PARTITION BY user_id)', 'ts')} / 24) AS BIGINT) AS hosp_day FROM events),
    s AS (SELECT *, lag(value) OVER w AS pv, lag(ts) OVER w AS pt FROM d WINDOW w AS (PARTITION BY user_id, hosp_day ORDER BY ts, event_id))
    SELECT user_id, hosp_day, min(ts) AS first_datetime, max(ts) AS last_datetime, arg_min(value, (ts, event_id)) AS first_result, arg_max(value, (ts, event_id)) AS last_result, min(value) AS min_result,
           max(value) AS max_result, round(median(value), 4) AS median_result, round(sum(value), 4) AS cum_sum, round(coalesce(sum((value + pv) / 2 * {hours('pt', 'ts')}), 0), 4) AS auc, round({hours('min(ts)', 'max(ts)')}, 4) AS duration,
           round(coalesce(sum((value + pv) / 2 * {hours('pt', 'ts')}), 0) / nullif({hours('min(ts)', 'max(ts)')}, 0), 4) AS time_wt_avg FROM s GROUP BY 1, 2
""")
def series_day_summary(t):
    rows = series.Ordered(t.events.drop("props"), KEY, [TS, *TIE]).whole(admit=("min", "ts"))
    rows = rows.with_columns({"hosp_day": F.floor(elapsed("admit", "ts", "hours") / 24).cast("bigint")})
    return _rounded(courses.series_summary(rows, ["user_id", "hosp_day"], TS, "value", TIE), 4)


@query("diagnosis_flags", "K7 B6", f"""
    WITH {_DX}, f AS (SELECT l_orderkey, {_ICD_CASE} AS label FROM dx)
    SELECT l_orderkey, {", ".join(f"bool_or(label = '{n}') AS pmh_{n}" for n in sorted(_ICD))} FROM f WHERE label IS NOT NULL GROUP BY 1
""")
def diagnosis_flags(t):
    return cohort.icd_flags(_dx(t), ["l_orderkey"], "code", _ICD, "pmh_", fill=False)


@query("cohort_by_code", "K8 C12", f"""
    WITH {_DX}
    SELECT o_orderkey, o_custkey, o_orderdate FROM (SELECT *, TIMESTAMP '1975-01-01' + to_days(CAST((o_custkey * 37) % 9000 AS INTEGER)) AS birth FROM orders)
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31 23:59:59' AND floor(date_diff('day', birth::DATE, o_orderdate::DATE) / 365.25e0) >= 18
      AND o_orderkey IN (SELECT l_orderkey FROM dx WHERE regexp_matches(code, '^I2.\\.') AND l_linestatus = 'F' AND l_linenumber <= 2 AND p_type <> 'PROMO')
""")
def cohort_by_code(t):
    birth = F.date_add(F.lit("1975-01-01").cast("date"), (F.col("o_custkey") * 37 % 9000).cast("int"))
    enc = t.orders.withColumnRenamed("o_orderkey", "l_orderkey").withColumn("birth", birth)
    when = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") <= 2) & (F.col("p_type") != "PROMO")
    rules = [F.col("o_orderdate").between("1996-01-01", "1999-12-31 23:59:59"), adult("birth", "o_orderdate")]
    out = cohort.cohort(_dx(t), enc, "l_orderkey", "code", r"^I2.\.", when, rules)
    return out.select(F.col("l_orderkey").alias("o_orderkey"), "o_custkey", "o_orderdate")


def _exclusion_rules():
    return {
        "excl_status": F.col("o_orderstatus") == "P", "excl_low": F.col("o_totalprice") < 50000, "excl_priority": F.col("o_orderpriority").rlike("^5"),
    }


_EXCL = "x AS (SELECT *, o_orderstatus = 'P' AS a, o_totalprice < 50000 AS b, regexp_matches(o_orderpriority, '^5') AS c FROM orders)"


@query("exclusion_cascade", "K9", f"WITH {_EXCL} SELECT o_orderkey, o_custkey, o_totalprice FROM x WHERE NOT a AND NOT b AND NOT c")
def exclusion_cascade(t):
    return cohort.exclusion_cascade(t.orders, _exclusion_rules())[0].select("o_orderkey", "o_custkey", "o_totalprice")


@query("exclusion_attrition", "K9", f"""
    WITH {_EXCL} SELECT 0::BIGINT AS step_no, 'start' AS step, count(*) AS n_rule, count(*) AS n_left FROM x
    UNION ALL SELECT 1, 'excl_status', count(*) FILTER (a), count(*) FILTER (NOT a) FROM x UNION ALL SELECT 2, 'excl_low', count(*) FILTER (b), count(*) FILTER (NOT a AND NOT b) FROM x
    UNION ALL SELECT 3, 'excl_priority', count(*) FILTER (c), count(*) FILTER (NOT a AND NOT b AND NOT c) FROM x
""")
def exclusion_attrition(t):
    return cohort.exclusion_cascade(t.orders, _exclusion_rules())[1]


def _with_admit(t):
    return series.Ordered(t.events.drop("props"), KEY, [TS, *TIE]).whole(admit=("min", "ts")).result()


@query("baseline_values", "K10 C13 I2", f"""
    WITH a AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS admit FROM events), f AS (SELECT * FROM a WHERE ts BETWEEN admit - INTERVAL 6 HOUR AND admit + INTERVAL 48 HOUR
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1)
    SELECT user_id, {", ".join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS {k}_admit" for k in TYPES)} FROM f GROUP BY 1
""")
def baseline_values(t):
    return features.baseline_value(_with_admit(t), KEY, TS, "admit", "event_type", "value", TYPES, 6, 48, TIE)


@query("timed_snapshots", "K11 D3 D4 H5", """
    WITH a AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS admit FROM events),
    p AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r1, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r2,
      row_number() OVER (PARTITION BY user_id, event_type ORDER BY abs(epoch_us(ts) - epoch_us(admit) - 86400000000), ts, event_id) AS r3 FROM a)
    SELECT user_id, event_type, 'ADMIT' AS timing, ts AS at, value FROM p WHERE r1 = 1 UNION ALL SELECT user_id, event_type, 'DISCH', ts, value FROM p WHERE r2 = 1
    UNION ALL SELECT user_id, event_type, 'HR24', ts, value FROM p WHERE r3 = 1
""")
def timed_snapshots(t):
    return features.timed_snapshots(_with_admit(t), KEY, TS, "admit", "event_type", "value", 24, TIE)


@query("icu_length_of_stay", "K12 G6", f"""
    WITH h AS (SELECT *, lead(ts) OVER {W} AS stop FROM events), r AS (SELECT *, {days('ts', 'stop')} AS len FROM h WHERE stop IS NOT NULL), f AS (SELECT * FROM r WHERE len >= 1e0 / 1440)
    SELECT user_id, round(sum(len), 6) AS icu_los, min(ts) AS icu_start, max(stop) AS icu_stop FROM f WHERE event_type IN ('click', 'view') GROUP BY 1
""")
def icu_length_of_stay(t):
    history = series.neighbours(t.events.drop("props"), KEY, [TS, *TIE], stop=("lead", "ts"))
    return _rounded(features.icu_los(history, KEY, TS, "stop", "event_type", ["click", "view"], TIE))


@query("admission_unit", "K13 E13", """
    SELECT user_id, event_type AS admit_unit FROM (SELECT * FROM events WHERE event_type NOT IN ('error') QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1) WHERE event_type IN ('click', 'view', 'purchase')
""")
def admission_unit(t):
    return features.admit_unit(t.events, KEY, [TS, *TIE], "event_type", ["error"], ["click", "view", "purchase"])


_IO = """SELECT user_id, date_trunc('day', {ts}) AS event_date, round(sum(value) FILTER (event_type IN ('click', 'view')), 4) AS io_in,
    round(coalesce(sum(value) FILTER (event_type IN ('purchase', 'error', 'signup')), 0), 4) AS io_out,
    coalesce(bool_or(event_type = 'error') FILTER (event_type IN ('purchase', 'error', 'signup')), FALSE) AS catheter,
    round(sum(value) FILTER (event_type IN ('click', 'view')) - coalesce(sum(value) FILTER (event_type IN ('purchase', 'error', 'signup')), 0), 4) AS io_net FROM events GROUP BY 1, 2"""


def _io(t, day):
    rows = t.events.withColumn("io_type", F.when(F.col("event_type").isin("click", "view"), "IN").otherwise("OUT"))
    return _rounded(features.io_balance(rows, KEY, TS, "io_type", "value", F.col("event_type") == "error", day), 4)


@query("fluid_balance_by_date", "K17 G15", _IO.format(ts="ts"))
def fluid_balance_by_date(t):
    return _io(t, "calendar")


@query("fluid_balance_by_shift", "K17 G15", _IO.format(ts="ts - INTERVAL 7 HOUR"))
def fluid_balance_by_shift(t):
    return _io(t, "shift")


_PRODUCT = "CASE p_type WHEN 'PROMO' THEN 'RBC unit' WHEN 'STANDARD' THEN 'Thawed Plasma' WHEN 'SMALL' THEN 'FFP' WHEN 'LARGE' THEN 'Plts apheresis' WHEN 'MEDIUM' THEN 'Cryo pool' ELSE 'Saline' END"
_BLOOD = {"whole": "WB", "prbc": "RBC", "ffp": "Plasma|FFP", "platelets": "PHP|Plts", "cryo": "Cryo"}


@query("blood_products", "K18 E5", f"""
    WITH b AS (SELECT l_orderkey, l_linestatus, l_quantity, CASE {" ".join(f"WHEN regexp_matches(product, '{p}') THEN '{n}'" for n, p in _BLOOD.items())} END AS c FROM (
      SELECT l.*, {_PRODUCT} AS product FROM lineitem l JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate <= o_orderdate + INTERVAL 4 HOUR)),
    s AS (SELECT l_orderkey, {", ".join(f"sum(l_quantity) FILTER (l_linestatus = 'O' AND c = '{n}') AS prod_{n}, sum(l_quantity) FILTER (l_linestatus = 'F' AND c = '{n}') AS io_{n}" for n in _BLOOD)} FROM b WHERE c IS NOT NULL GROUP BY 1)
    SELECT *, {", ".join(f"prod_{n} IS NOT NULL OR coalesce(io_{n} > 0, FALSE) AS blood_{n}" for n in _BLOOD)} FROM s
""")
def blood_products(t):
    names = {"PROMO": "RBC unit", "STANDARD": "Thawed Plasma", "SMALL": "FFP", "LARGE": "Plts apheresis", "MEDIUM": "Cryo pool"}

    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), decode("p_type", names, "Saline").alias("product"))
    anchors = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("admit"))
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linestatus", "l_quantity", "l_shipdate").join(parts, "l_partkey").join(anchors, "l_orderkey")
    return features.blood_products_by_source(rows, ["l_orderkey"], "l_shipdate", "admit", "product", "l_quantity", "l_linestatus", "O", "F")


@query("no_exposure_before_index", "K19 E7 E9", """
    SELECT o_orderkey, o_orderdate FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_shipdate < o.o_orderdate)
""")
def no_exposure_before_index(t):
    index = t.orders.select("o_orderkey", "o_orderdate")
    doses = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return features.no_exposure_before(index, doses, ["o_orderkey"], "o_orderdate", "l_shipdate")


@query("prior_therapy_before_index", "K20 F10", f"""
    WITH p AS (SELECT o_custkey, l_shipdate, l_returnflag, l_quantity, l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    i AS (SELECT o_custkey, l_shipdate AS start, l_quantity >= 25 AS loaded FROM p WHERE l_returnflag = 'R' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity) = 1),
    r AS (SELECT o_custkey, l_returnflag, start, loaded, min(l_shipdate) AS a, max(l_shipdate) AS b FROM p JOIN i USING (o_custkey) WHERE l_returnflag <> 'R' AND l_shipdate < start GROUP BY 1, 2, 3, 4),
    g AS (SELECT *, {days('a', 'b')} AS d, {days('b', 'start')} AS gap FROM r WHERE {days('b', 'start')} < 90),
    s AS (SELECT o_custkey, loaded, arg_max(l_returnflag, (b, l_returnflag)) AS medication, sum(d) AS duration, min(gap) AS stop_to_index FROM g GROUP BY 1, 2)
    SELECT *, loaded OR duration > 30 AS full_load, NOT loaded AND duration > 30 AS other_load FROM s
""")
def prior_therapy_before_index(t):
    persons = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    doses = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_shipdate").join(persons, "l_orderkey")
    index = pick.pick_first(doses.filter("l_returnflag = 'R'"), ["o_custkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"])
    index = index.select("o_custkey", F.col("l_shipdate").alias("start"), (F.col("l_quantity") >= 25).alias("loaded"))
    others = doses.filter("l_returnflag <> 'R'").select("o_custkey", "l_returnflag", "l_shipdate")
    return features.prior_therapy(others, index, ["o_custkey"], "l_shipdate", "l_returnflag", "start", "loaded", max_gap_days=90, load_days=30)


@query("drugs_after_index", "K21 C14 I1", f"""
    WITH i AS (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS a, min(ts) FILTER (event_type = 'error') AS b FROM events GROUP BY 1)
    SELECT i.user_id, {", ".join(f"coalesce(bool_or(event_type = '{k}' AND (ts > a OR ts > b)), FALSE) AS after_{k}" for k in ("click", "purchase", "view"))} FROM i LEFT JOIN events e USING (user_id) GROUP BY 1
""")
def drugs_after_index(t):
    index = t.events.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("a"), F.min(F.when(F.col("event_type") == "error", F.col("ts"))).alias("b")
    )
    doses = t.events.select("user_id", "ts", "event_type")
    return fill_flags(features.med_after_index(index, doses, KEY, TS, "event_type", ["click", "purchase", "view"], ["a", "b"], "after_"))


@query("positive_cultures", "K22 C5 I1", """
    WITH c AS (SELECT user_id, event_type AS lab, CASE WHEN value < 20 THEN 'No Growth at 48 h' WHEN value < 40 THEN 'Normal Flora' WHEN value < 60 THEN 'Yeast' ELSE 'Organism' END AS v FROM events)
    SELECT user_id, bool_or(lab = 'click') AS positive_click, bool_or(lab = 'view') AS positive_view FROM c
    WHERE NOT regexp_matches(v, '(?i)no growth|flora') AND NOT (lab = 'view' AND regexp_matches(v, '(?i)yeast')) GROUP BY 1
""")
def positive_cultures(t):
    v = F.col("value")
    text = F.when(v < 20, "No Growth at 48 h").when(v < 40, "Normal Flora").when(v < 60, "Yeast").otherwise("Organism")
    rows = t.events.select("user_id", F.col("event_type").alias("lab"), text.alias("culture"))
    return fill_flags(features.culture_positive(rows, KEY, "lab", "culture", ["click", "view"], not_counted={"view": "(?i)yeast"}))


@query("culture_organisms", "K22 E17", """
    SELECT p.l_orderkey, p.l_partkey AS culture, c.p_brand AS organism, count(*) AS n FROM lineitem p JOIN (SELECT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber > 1 AND p_type = 'PROMO') c
    ON c.l_orderkey = p.l_orderkey WHERE p.l_linenumber = 1 GROUP BY 1, 2, 3
""")
def culture_organisms(t):
    names = t.part.filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("organism"))
    results = t.lineitem.filter("l_linenumber > 1").join(names, "l_partkey").groupBy("l_orderkey", "organism").agg(F.count("*").alias("n_child"))
    parents = t.lineitem.filter("l_linenumber = 1").groupBy("l_orderkey", F.col("l_partkey").alias("culture")).agg(F.count("*").alias("n_parent"))
    # counts on both sides stand for their rows, so copies are never paired up
    return parents.join(results, "l_orderkey").select("l_orderkey", "culture", "organism", (F.col("n_parent") * F.col("n_child")).alias("n"))


@query("drug_class_expansion", "K24 B14", """
    SELECT p_partkey, p_name FROM part WHERE lower(p_name) IN (SELECT lower(p_name) FROM part WHERE p_type = 'PROMO' AND p_size > 40)
""")
def drug_class_expansion(t):
    members = t.part.filter("p_type = 'PROMO' and p_size > 40").select(F.upper("p_name").alias("drug"))
    return features.drug_class_codes(t.part, "p_partkey", "p_name", members, "drug")


@query("start_time_matrix", "K25 I2 J7", f"""
    WITH a AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS admit FROM events)
    SELECT user_id, {", ".join(f"min({hours('admit', 'ts')}) FILTER (event_type = '{k}') AS {k}_start_hrs" for k in TYPES)} FROM a GROUP BY 1
""")
def start_time_matrix(t):
    return features.start_time_matrix(_with_admit(t), KEY, TS, "admit", "event_type", TYPES)


@query("patients_per_group", "K26 F3", """
    SELECT n_name, o_orderpriority, count(DISTINCT o_custkey) AS n_patients FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2
""")
def patients_per_group(t):
    # count per (group, patient) first: the dimensions then join far fewer rows
    pairs = t.orders.select("o_custkey", "o_orderpriority").distinct()
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    named = joins.decode_codes(pairs.join(people, "o_custkey"), t.nation, "n_nationkey", "n_name", {"c_nationkey": "n_name"})
    return features.group_counts(named, ["n_name", "o_orderpriority"], "o_custkey")


@query("time_since_admission_days", "G13 K10", f"SELECT event_id, CAST(floor({days('min(ts) OVER (PARTITION BY user_id)', 'ts')}) AS BIGINT) + 1 AS hosp_day FROM events")
def time_since_admission_days(t):
    return _with_admit(t).select("event_id", hosp_day("ts", "admit", base=1).alias("hosp_day"))


@query("encounter_report", "D3 F7 F15 F16 G2", f"""
    WITH s AS (SELECT *, first_value(ts) OVER {W} AS t0, first_value(value) OVER {W} AS v0, coalesce({hours('ts', f'lead(ts) OVER {W}')}, 1e0) AS d FROM events),
    n AS (SELECT user_id, value AS v24 FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY abs(epoch_us(ts) - epoch_us(t0) - 86400000000), ts, event_id) = 1)
    SELECT s.user_id, min(v0) AS first_value, min(value) AS lowest_value, round(any_value(v24) - min(v0), 6) AS change_24h, count(*) AS n_readings, count(*) FILTER (value < 20) AS low_num,
           round(coalesce(sum(d) FILTER (value < 20), 0), 4) AS low_hours, round(coalesce(sum(d) FILTER (value < 20), 0) / sum(d) * 100, 4) AS low_pct, round({hours('min(ts)', 'max(ts)')}, 4) AS observed_hours
    FROM s JOIN n USING (user_id) GROUP BY 1
""")
def encounter_report(t):
    """Per encounter: first, lowest, change nearest 24 h, and time below the threshold.

    One exchange by encounter: the window and the aggregate share it.
    """
    o = series.Ordered(t.events.select("user_id", "ts", "event_id", "value"), KEY, [TS, *TIE])
    rows = o.look(nt=("lead", "ts")).whole(t0=("min", "ts")).result()
    rows = rows.withColumn("d", F.coalesce(elapsed("ts", "nt", "hours"), F.lit(1.0)))
    gap = F.abs(F.unix_micros("ts") - F.unix_micros("t0") - F.lit(86_400_000_000))
    low = F.col("value") < 20
    low_hours = F.coalesce(F.sum(F.when(low, F.col("d"))), F.lit(0.0))
    first = F.min_by("value", F.struct("ts", "event_id"))
    return rows.groupBy("user_id").agg(
        first.alias("first_value"), F.min("value").alias("lowest_value"), F.round(F.min_by("value", F.struct(gap.alias("g"), "ts", "event_id")) - first, 6).alias("change_24h"),
        F.count("*").alias("n_readings"), F.count_if(low).alias("low_num"), F.round(low_hours, 4).alias("low_hours"),
        F.round(low_hours / F.sum("d") * 100, 4).alias("low_pct"), F.round(elapsed(F.min("ts"), F.max("ts"), "hours"), 4).alias("observed_hours"),
    )


@query("dose_report", "F10", """
    WITH d AS (SELECT l_orderkey, count(*) AS n_doses, sum(l_quantity) AS total, min(l_shipdate) AS first_dose, count(*) FILTER (l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY 1)
    SELECT c_mktsegment, o_orderstatus, count(*) AS n_encounters, sum(n_doses)::BIGINT AS n_doses, sum(total) AS total_dose, count(*) FILTER (first_dose < o_orderdate) AS n_before_admission
    FROM orders JOIN d ON d.l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
""")
def dose_report(t):
    doses = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"), F.min("l_shipdate").alias("first_dose"))
    rows = t.orders.join(doses, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return rows.groupBy("c_mktsegment", "o_orderstatus").agg(
        F.count("*").alias("n_encounters"), F.sum("n").alias("n_doses"), F.sum("total").alias("total_dose"),
        F.count_if(F.col("first_dose") < F.col("o_orderdate")).alias("n_before_admission"),
    )


@query("survival_of_readings", "F27 F12", f"""
    SELECT bin, count(DISTINCT user_id) AS n_users, count(*) AS n FROM (SELECT user_id, floor({hours('min(ts) OVER (PARTITION BY user_id)', 'ts')} / 72) * 72 AS bin FROM events) GROUP BY 1
""")
def survival_of_readings(t):
    rows = _with_admit(t).select("user_id", (F.floor(elapsed("admit", "ts", "hours") / 72) * 72.0).alias("bin"))
    return rows.groupBy("bin").agg(F.count_distinct("user_id").alias("n_users"), F.count("*").alias("n"))


@query("bolus_by_weight", "K14 E14", """
    WITH d AS (SELECT o_custkey AS person, l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity - 5 AS dose, CASE l_returnflag WHEN 'A' THEN 'mg' WHEN 'N' THEN 'microgram' ELSE 'mL' END AS unit FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      WHERE l_linestatus = 'F'),
    w AS (SELECT o_custkey AS person, o_orderdate, o_totalprice / 1000 AS weight FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
    SELECT d.l_orderkey, d.l_linenumber::BIGINT AS l_linenumber, d.l_partkey, round(CASE unit WHEN 'mg' THEN dose * 1000 / weight ELSE dose / weight END, 6) AS bolus
    FROM d ASOF JOIN w ON d.person = w.person AND d.l_shipdate >= w.o_orderdate WHERE dose > 0 AND unit <> 'mL'
""")
def bolus_by_weight(t):
    doses = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person")), "l_orderkey").select(
        "person", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_shipdate", (F.col("l_quantity") - 5).alias("dose"),
        F.when(F.col("l_returnflag") == "A", "mg").when(F.col("l_returnflag") == "N", "microgram").otherwise("mL").alias("unit"), F.when(F.col("l_linestatus") != "F", "Begin Bag").alias("iv_event"),
    )
    weights = t.orders.select(F.col("o_custkey").alias("person"), F.col("o_orderdate").alias("weighed"), "o_orderkey", (F.col("o_totalprice") / 1000).alias("weight"))
    out = features.bolus_per_weight(doses, weights, ["person"], "l_shipdate", "dose", "unit", "iv_event", "weighed", "weight", ["o_orderkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("bolus", 6).alias("bolus"))
