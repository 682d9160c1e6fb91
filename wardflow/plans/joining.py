"""Joins."""

from pyspark.sql import functions as F

from ..functions.predicates import around
from ..functions.scalar import elapsed, offset
from ..operators import joins, reshape
from ..operators.features import original_order_id
from ..operators.agg import part_of_total
from ..operators.pick import pick_first
from ..operators.series import rolling
from .registry import days, hours, query

def line():
    return F.col("l_linenumber").cast("bigint").alias("l_linenumber")


@query("inner_equi_join", "E1", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, c_name, p_brand, s_name FROM lineitem, orders, customer, part, supplier
    WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_partkey = p_partkey AND l_suppkey = s_suppkey AND l_quantity > 25
""")
def inner_equi_join(t):
    rows = t.lineitem.filter("l_quantity > 25").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", line(), "c_name", "p_brand", "s_name")


@query("outer_join_optional_side", "E2", """
    SELECT o_orderkey, l_linenumber::DOUBLE AS line, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_linestatus = 'O'
""")
def outer_join_optional_side(t):
    right = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    hit = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return joins.left_optional(t.orders.select("o_orderkey"), right, "o_orderkey", hit).select(
        "o_orderkey", F.col("l_linenumber").cast("double").alias("line"), "l_quantity"
    )


@query("composite_key_left_join", "E3", """
    WITH w AS (SELECT l_orderkey, l_shipdate, l_returnflag, max(l_quantity) AS max_quantity FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
    SELECT l.l_orderkey, l.l_linenumber::BIGINT AS l_linenumber, l.l_shipdate, w.max_quantity FROM lineitem l LEFT JOIN w USING (l_orderkey, l_shipdate, l_returnflag) WHERE l_linestatus = 'O'
""")
def composite_key_left_join(t):
    keys = ["l_orderkey", "l_shipdate", "l_returnflag"]
    best = t.lineitem.filter("l_linestatus = 'F'").groupBy(*keys).agg(F.max("l_quantity").alias("max_quantity"))
    return t.lineitem.filter("l_linestatus = 'O'").join(best, keys, "left").select("l_orderkey", line(), "l_shipdate", "max_quantity")


@query("wide_assembly", "E4", """
    WITH d AS (SELECT l_orderkey, sum(l_quantity) AS total_dose, min(l_shipdate) AS first_dose, count(*)::DOUBLE AS n_doses FROM lineitem GROUP BY 1),
    r AS (SELECT l_orderkey, TRUE AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), x AS (SELECT l_orderkey, max(l_tax) AS max_tax FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
    SELECT o_orderkey AS l_orderkey, o_orderdate, total_dose, first_dose, n_doses, coalesce(returned, FALSE) AS returned, max_tax
    FROM orders LEFT JOIN d ON d.l_orderkey = o_orderkey LEFT JOIN r ON r.l_orderkey = o_orderkey LEFT JOIN x ON x.l_orderkey = o_orderkey
""")
def wide_assembly(t):
    # Features of one fact come from one aggregate.
    returned, is_open = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    doses = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("total_dose"), F.min("l_shipdate").alias("first_dose"), F.count("*").cast("double").alias("n_doses"),
        F.bool_or(returned).alias("returned"), F.max(F.when(is_open, F.col("l_tax"))).alias("max_tax"),
    )
    base = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return joins.assemble(base, [doses], "l_orderkey").withColumn("returned", F.coalesce("returned", F.lit(False)))


@query("assembled_parts", "E4", """
    WITH o AS (SELECT o_custkey AS k, count(*)::DOUBLE AS n_orders, max(o_totalprice) AS top_price FROM orders GROUP BY 1),
    l AS (SELECT o_custkey AS k, sum(l_quantity) AS total_dose, min(l_shipdate) AS first_dose FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
    e AS (SELECT user_id AS k, count(*)::DOUBLE AS n_readings, max(value) AS top_value FROM events GROUP BY 1),
    f AS (SELECT user_id AS k, event_type AS first_kind FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
    x AS (SELECT o_custkey AS k, bool_or(o_orderstatus = 'F') AS finished, max(o_orderdate) AS last_order FROM orders WHERE o_totalprice > 100000 GROUP BY 1),
    p AS (SELECT user_id AS k, count(*) FILTER (event_type = 'click')::DOUBLE AS clicks, count(*) FILTER (event_type = 'error')::DOUBLE AS errors FROM events WHERE value > 20 GROUP BY 1)
    SELECT c_custkey AS k, c_mktsegment, n_orders, top_price, total_dose, first_dose, n_readings, top_value, first_kind, finished, last_order, clicks, errors
    FROM customer LEFT JOIN o ON o.k = c_custkey LEFT JOIN l ON l.k = c_custkey LEFT JOIN e ON e.k = c_custkey LEFT JOIN f ON f.k = c_custkey LEFT JOIN x ON x.k = c_custkey LEFT JOIN p ON p.k = c_custkey
""")
def assembled_parts(t):
    def count(when=None):
        return (F.count("*") if when is None else F.count_if(when)).cast("double")

    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("k"))
    kind = F.col("event_type")
    orders, events = t.orders.withColumnRenamed("o_custkey", "k"), t.events.withColumnRenamed("user_id", "k")
    parts = [
        orders.groupBy("k").agg(count().alias("n_orders"), F.max("o_totalprice").alias("top_price")),
        t.lineitem.join(owner, "l_orderkey").groupBy("k").agg(F.sum("l_quantity").alias("total_dose"), F.min("l_shipdate").alias("first_dose")),
        events.groupBy("k").agg(count().alias("n_readings"), F.max("value").alias("top_value")),
        pick_first(events, ["k"], ["ts", "event_id"]).select("k", F.col("event_type").alias("first_kind")),
        orders.filter("o_totalprice > 100000").groupBy("k").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("finished"), F.max("o_orderdate").alias("last_order")),
        events.filter("value > 20").groupBy("k").agg(count(kind == "click").alias("clicks"), count(kind == "error").alias("errors")),
    ]
    return joins.assemble(t.customer.select(F.col("c_custkey").alias("k"), "c_mktsegment"), parts, "k")


@query("full_outer_merge", "E5", """
    SELECT l_orderkey, day, i.vol AS vol_in, o.vol AS vol_out FROM
      (SELECT l_orderkey, date_trunc('month', l_shipdate) AS day, sum(l_quantity) AS vol FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2) i
      FULL JOIN (SELECT l_orderkey, date_trunc('month', l_shipdate) AS day, sum(l_quantity) AS vol FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2) o USING (l_orderkey, day)
""")
def full_outer_merge(t):
    def volumes(status, name):
        rows = t.lineitem.filter(F.col("l_linestatus") == status).withColumn("day", F.date_trunc("month", "l_shipdate"))
        return rows.groupBy("l_orderkey", "day").agg(F.sum("l_quantity").alias(name))

    return joins.merge_full([volumes("O", "vol_in"), volumes("F", "vol_out")], ["l_orderkey", "day"])


@query("semi_join", "E6", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)
""")
def semi_join(t):
    ids = t.lineitem.filter("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.restrict_to(t.orders.select("o_orderkey", "o_totalprice"), ids, "o_orderkey")


@query("anti_join", "E7 E8", """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def anti_join(t):
    ids = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.restrict_to(t.customer.select("c_custkey", "c_name"), ids, "c_custkey", keep=False)


@query("not_in_list", "E8", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.08)")
def not_in_list(t):
    used = t.lineitem.filter("l_discount > 0.08").select(F.col("l_partkey").alias("p_partkey"))
    return joins.restrict_to(t.part.select("p_partkey"), used, "p_partkey", keep=False)


def _stays(t):
    return t.orders.select(
        F.col("o_custkey").alias("person"), "o_orderkey", F.col("o_orderdate").alias("stay_start"), offset("o_orderdate", 30, "days").alias("stay_stop")
    )


@query("point_in_interval_join", "E9 E23", """
    SELECT l.l_orderkey, l.l_linenumber::BIGINT AS l_linenumber, l.l_shipdate, s.o_orderkey AS stay, s.o_orderdate AS stay_start
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN orders s ON s.o_custkey = o.o_custkey AND l.l_shipdate BETWEEN s.o_orderdate AND s.o_orderdate + INTERVAL 30 DAY
""")
def point_in_interval_join(t):
    persons = t.orders.select("o_orderkey", F.col("o_custkey").alias("person")).withColumnRenamed("o_orderkey", "l_orderkey")
    points = t.lineitem.select("l_orderkey", line(), "l_shipdate").join(persons, "l_orderkey")
    spans = _stays(t).withColumnRenamed("o_orderkey", "stay")
    out = joins.interval_join(points, spans, ["person"], "l_shipdate", "stay_start", "stay_stop")
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "stay", "stay_start")


@query("interval_join_left", "E9", """
    SELECT e.event_id, e.user_id, d.day_start FROM events e LEFT JOIN (SELECT DISTINCT user_id, date_trunc('day', ts) AS day_start FROM events WHERE event_type = 'purchase') d
    ON d.user_id = e.user_id AND e.ts >= d.day_start AND e.ts <= d.day_start + INTERVAL 12 HOUR
""")
def interval_join_left(t):
    spans = t.events.filter("event_type = 'purchase'").select("user_id", F.date_trunc("day", "ts").alias("day_start")).distinct()
    spans = spans.withColumn("day_mid", offset("day_start", 12))
    out = joins.interval_join(t.events.select("event_id", "user_id", "ts"), spans, ["user_id"], "ts", "day_start", "day_mid", how="left")
    return out.select("event_id", "user_id", "day_start")


@query("interval_overlap_join", "E10", """
    WITH c AS (SELECT l_orderkey, l_suppkey, min(l_shipdate) AS c0, max(l_shipdate) AS c1 FROM lineitem GROUP BY 1, 2),
    p AS (SELECT o.o_custkey, c.* FROM c JOIN orders o ON o.o_orderkey = c.l_orderkey)
    SELECT p.l_orderkey, p.l_suppkey, s.o_orderkey AS stay, (p.c0 >= s.o_orderdate AND p.c0 < s.o_orderdate + INTERVAL 30 DAY) AS starts_within
    FROM p JOIN orders s ON s.o_custkey = p.o_custkey AND p.c0 <= s.o_orderdate + INTERVAL 30 DAY AND s.o_orderdate <= p.c1
""")
def interval_overlap_join(t):
    courses = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.min("l_shipdate").alias("course_start"), F.max("l_shipdate").alias("course_stop"))
    persons = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person"))
    out = joins.overlap_join(
        courses.join(persons, "l_orderkey"), _stays(t).withColumnRenamed("o_orderkey", "stay"), ["person"], "course_start", "course_stop", "stay_start", "stay_stop"
    )
    within = (F.col("course_start") >= F.col("stay_start")) & (F.col("course_start") < F.col("stay_stop"))
    return out.select("l_orderkey", "l_suppkey", "stay", within.alias("starts_within"))


def _doses_by_person(t):
    persons = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person"))
    return t.lineitem.select("l_orderkey", line(), "l_partkey", "l_shipdate").join(persons, "l_orderkey")


_STATES = """s AS (SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
    d AS (SELECT o_custkey, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_shipdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


@query("asof_state_at_event", "E11", f"""
    WITH {_STATES}
    SELECT d.l_orderkey, d.l_linenumber, d.l_partkey, s.o_orderkey::DOUBLE AS state_order, s.o_orderstatus AS state FROM d ASOF LEFT JOIN s ON d.o_custkey = s.o_custkey AND d.l_shipdate >= s.o_orderdate
""")
def asof_state_at_event(t):
    states = t.orders.select(F.col("o_custkey").alias("person"), "o_orderdate", F.col("o_orderkey").alias("state_order"), F.col("o_orderstatus").alias("state"))
    out = joins.asof_join(_doses_by_person(t), states, ["person"], "l_shipdate", "o_orderdate", ["state_order", "state"], ["state_order"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("state_order").cast("double").alias("state_order"), "state")


@query("asof_with_validity", "E11", f"""
    WITH {_STATES}
    SELECT d.l_orderkey, d.l_linenumber, d.l_partkey, s.o_orderkey AS state_order FROM d ASOF JOIN s ON d.o_custkey = s.o_custkey AND d.l_shipdate >= s.o_orderdate
    WHERE d.l_shipdate <= s.o_orderdate + INTERVAL 90 DAY AND s.o_orderstatus <> 'P'
""")
def asof_with_validity(t):
    states = t.orders.select(
        F.col("o_custkey").alias("person"), F.col("o_orderdate").alias("beg"), offset("o_orderdate", 90, "days").alias("end"),
        F.col("o_orderkey").alias("state_order"), F.col("o_orderstatus").alias("state"),
    )
    out = joins.asof_join(
        _doses_by_person(t), states, ["person"], "l_shipdate", "beg", ["state_order", "state"], ["state_order"], valid_from="beg", valid_to="end", how="inner"
    )
    return out.filter("state <> 'P'").select("l_orderkey", "l_linenumber", "l_partkey", "state_order")


_HISTORIES = """e AS (SELECT o_orderkey, o_custkey AS person, o_orderdate + INTERVAL 966 HOUR AS t FROM orders),
    a AS (SELECT o_custkey AS person, o_orderdate AS at, o_orderdate + (o_orderkey % 5 - 2) * INTERVAL 1 DAY AS f, o_orderdate + INTERVAL 90 DAY AS u, o_orderkey AS loc_order, o_orderstatus AS location FROM orders),
    b AS (SELECT o_custkey AS person, date_trunc('month', l_shipdate) AS at, l_shipdate AS f, l_shipdate + INTERVAL 20 DAY AS u, l_orderkey, l_linenumber, l_suppkey AS attending FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    lb AS (SELECT e.o_orderkey, max(b.at) AS at FROM e JOIN b ON b.person = e.person AND b.at <= e.t GROUP BY 1)"""


def _order_events(t):
    return t.orders.select(F.col("o_custkey").alias("person"), "o_orderkey", offset("o_orderdate", 966).alias("ordered"))


def _attending(t):
    """A history by month whose periods begin within the month, so an instant has many states."""
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person"))
    return t.lineitem.join(owner, "l_orderkey").select(
        "person", F.date_trunc("month", "l_shipdate").alias("month"), F.col("l_shipdate").alias("att_from"), offset("l_shipdate", 20, "days").alias("att_to"),
        F.col("l_orderkey").alias("att_order"), F.col("l_linenumber").cast("bigint").alias("att_line"), F.col("l_suppkey").alias("attending"),
    )


@query("asof_two_histories", "E11 E12", f"""
    WITH {_HISTORIES},
    la AS (SELECT e.o_orderkey, max(a.at) AS at FROM e JOIN a ON a.person = e.person AND a.at <= e.t GROUP BY 1),
    fa AS (SELECT e.o_orderkey, a.loc_order, a.location FROM e JOIN la USING (o_orderkey) JOIN a ON a.person = e.person AND a.at = la.at AND e.t BETWEEN a.f AND a.u
      QUALIFY row_number() OVER (PARTITION BY e.o_orderkey ORDER BY loc_order DESC) = 1),
    fb AS (SELECT e.o_orderkey, b.attending FROM e JOIN lb USING (o_orderkey) JOIN b ON b.person = e.person AND b.at = lb.at AND e.t BETWEEN b.f AND b.u
      QUALIFY row_number() OVER (PARTITION BY e.o_orderkey ORDER BY b.l_orderkey DESC, b.l_linenumber DESC, b.attending DESC) = 1)
    SELECT o_orderkey, loc_order::DOUBLE AS loc_order, location, attending::DOUBLE AS attending FROM e LEFT JOIN fa USING (o_orderkey) LEFT JOIN fb USING (o_orderkey)
""")
def asof_two_histories(t):
    places = t.orders.select(
        F.col("o_custkey").alias("person"), F.col("o_orderdate").alias("moved"), (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 5 - 2).cast("int"))).alias("loc_from"),
        offset("o_orderdate", 90, "days").alias("loc_to"), F.col("o_orderkey").alias("loc_order"), F.col("o_orderstatus").alias("location"),
    )
    histories = [
        joins.History(places, "moved", ["loc_order", "location"], ["loc_order"], "loc_from", "loc_to"),
        joins.History(_attending(t), "month", ["attending"], ["att_order", "att_line"], "att_from", "att_to"),
    ]
    out = joins.asof_histories(_order_events(t), histories, ["person"], "ordered")
    return out.select("o_orderkey", F.col("loc_order").cast("double").alias("loc_order"), "location", F.col("attending").cast("double").alias("attending"))


@query("asof_every_tied_state", "E11 E12", f"""
    WITH {_HISTORIES}
    SELECT e.o_orderkey, b.l_orderkey AS att_order, b.l_linenumber::BIGINT AS att_line, b.attending FROM e JOIN lb USING (o_orderkey) JOIN b ON b.person = e.person AND b.at = lb.at AND e.t BETWEEN b.f AND b.u
""")
def asof_every_tied_state(t):
    cols = ["att_order", "att_line", "attending"]
    return joins.asof_tied(_order_events(t), _attending(t), ["person"], "ordered", "month", cols, "att_from", "att_to").select("o_orderkey", *cols)


@query("last_value_before_event", "E14", f"""
    WITH {_STATES}
    SELECT d.l_orderkey, d.l_linenumber, d.l_partkey, s.o_totalprice AS last_weight FROM d ASOF LEFT JOIN s ON d.o_custkey = s.o_custkey AND d.l_shipdate > s.o_orderdate
""")
def last_value_before_event(t):
    states = t.orders.select(F.col("o_custkey").alias("person"), "o_orderdate", "o_orderkey", F.col("o_totalprice").alias("last_weight"))
    out = joins.asof_join(_doses_by_person(t), states, ["person"], "l_shipdate", "o_orderdate", ["last_weight"], ["o_orderkey"], strict=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "last_weight")


@query("asof_within_series", "E11 E14", """
    WITH s AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
    SELECT e.event_id, s.value AS last_view FROM (SELECT * FROM events WHERE event_type <> 'view') e ASOF LEFT JOIN s ON e.user_id = s.user_id AND e.ts >= s.ts
""")
def asof_within_series(t):
    states = t.events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("value").alias("last_view"))
    events = t.events.filter("event_type <> 'view'").select("user_id", "event_id", "ts")
    return joins.asof_join(events, states, ["user_id"], "ts", "view_ts", ["last_view"]).select("event_id", "last_view")


@query("first_state_join", "E13", """
    SELECT user_id, event_type AS admit_unit, ts FROM (SELECT * FROM events WHERE event_type NOT IN ('error', 'signup') QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1) WHERE event_type IN ('click', 'view')
""")
def first_state_join(t):
    out = joins.first_state(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type", ["error", "signup"], ["click", "view"])
    return out.select("user_id", F.col("event_type").alias("admit_unit"), "ts")


@query("look_back_encounters", "E15", """
    SELECT a.o_orderkey, b.o_orderkey AS prior_o_orderkey, b.o_orderdate + INTERVAL 5 DAY AS prior_end FROM orders a JOIN orders b
    ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey AND b.o_orderdate + INTERVAL 5 DAY BETWEEN a.o_orderdate - INTERVAL 60 DAY AND a.o_orderdate
""")
def look_back_encounters(t):
    enc = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("start"), offset("o_orderdate", 5, "days").alias("end"))
    return joins.look_back(enc, "o_custkey", "start", "end", 60, [], "o_orderkey").select("o_orderkey", "prior_o_orderkey", "prior_end")


@query("nearest_prior_encounter", "E15", f"""
    SELECT o_orderkey, {days("lag(o_orderdate) OVER w", "o_orderdate")} AS days_since_prior FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def nearest_prior_encounter(t):
    enc = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return joins.prior_encounters(enc, "o_custkey", "o_orderdate", "o_orderdate", ["o_orderkey"]).select("o_orderkey", "days_since_prior")


@query("repeat_visit_exclusion", "E15 E8", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 10)
""")
def repeat_visit_exclusion(t):
    often = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 10")
    return joins.restrict_to(t.orders.select("o_orderkey", "o_custkey"), often, "o_custkey", keep=False)


@query("readmissions", "E16", """
    SELECT a.o_orderkey, b.o_orderkey AS next_o_orderkey, b.o_orderdate AS next_start FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey
    AND b.o_orderdate > a.o_orderdate + INTERVAL 5 DAY AND b.o_orderdate <= a.o_orderdate + INTERVAL 5 DAY + INTERVAL 4380 HOUR AND b.o_orderstatus IN ('F', 'O')
""")
def readmissions(t):
    enc = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("start"), offset("o_orderdate", 5, "days").alias("end"), "o_orderstatus")
    out = joins.look_forward(enc, "o_custkey", "start", "end", 182.5, ["o_orderkey", "o_orderstatus"])
    return out.filter(F.col("next_o_orderstatus").isin("F", "O")).select("o_orderkey", "next_o_orderkey", "next_start")


@query("parent_child_details", "E17 F9", """
    WITH c AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_linenumber > 1)
    SELECT p.l_orderkey, p.l_partkey, p.l_quantity, k.details FROM (SELECT * FROM lineitem WHERE l_linenumber = 1) p
    LEFT JOIN (SELECT l_orderkey, string_agg(l_returnflag, ', ' ORDER BY l_linenumber, l_returnflag) AS details FROM c GROUP BY 1) k ON k.l_orderkey = p.l_orderkey
""")
def parent_child_details(t):
    from ..operators.agg import text_list

    parents = t.lineitem.filter("l_linenumber = 1").select("l_orderkey", "l_partkey", "l_quantity")
    details = text_list(t.lineitem.filter("l_linenumber > 1"), ["l_orderkey"], "l_returnflag", ["l_linenumber"], name="details")
    return parents.join(details, "l_orderkey", "left")


@query("original_order_key", "E18", """
    SELECT d.l_orderkey, d.l_linenumber::BIGINT AS l_linenumber, o.o_custkey FROM (SELECT *, CASE WHEN template = 0 THEN l_orderkey ELSE template END AS orig FROM
      (SELECT *, CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_orderkey // 2 END AS template FROM lineitem)) d JOIN orders o ON o.o_orderkey = d.orig
""")
def original_order_key(t):
    doses = t.lineitem.withColumn("template", F.when(F.col("l_linestatus") == "O", F.lit(0)).otherwise(F.floor(F.col("l_orderkey") / 2)))
    doses = doses.withColumn("o_orderkey", original_order_id("template", "l_orderkey"))
    return doses.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey").select("l_orderkey", line(), "o_custkey")


@query("attribute_columns", "E19 I5", """
    SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_returnflag END) AS route, max(CASE WHEN l_linenumber = 2 THEN l_returnflag END) AS form,
           max(CASE WHEN l_linenumber = 3 THEN l_returnflag END) AS frequency FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_orderkey
""")
def attribute_columns(t):
    names = F.element_at(F.array(F.lit("route"), F.lit("form"), F.lit("frequency")), F.col("l_linenumber"))
    rows = t.lineitem.filter("l_linenumber <= 3").withColumn("meaning", names)
    return reshape.value_pivot(rows, ["l_orderkey"], "meaning", ["route", "form", "frequency"], "l_returnflag")


@query("cohort_with_transfers", "E21", """
    WITH c AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'P'),
    m AS (SELECT o_orderkey AS member, o_orderkey AS cohort_id FROM c UNION
          SELECT x.o_orderkey, c.o_orderkey FROM c JOIN orders x ON x.o_custkey = c.o_custkey AND x.o_orderdate BETWEEN c.o_orderdate - INTERVAL 30 DAY AND c.o_orderdate)
    SELECT m.cohort_id, count(*) AS n_doses, sum(l_quantity) AS total FROM lineitem JOIN m ON m.member = l_orderkey GROUP BY 1
""")
def cohort_with_transfers(t):
    chosen = t.orders.filter("o_orderstatus = 'P'").select("o_custkey", F.col("o_orderkey").alias("cohort_id"), offset("o_orderdate", -30, "days").alias("lo"), F.col("o_orderdate").alias("hi"))
    all_enc = t.orders.select("o_custkey", F.col("o_orderkey").alias("member"), "o_orderdate")
    linked = joins.interval_join(all_enc, chosen, ["o_custkey"], "o_orderdate", "lo", "hi").select("member", "cohort_id")
    members = chosen.select(F.col("cohort_id").alias("member"), "cohort_id").union(linked).distinct()
    doses = t.lineitem.select(F.col("l_orderkey").alias("member"), "l_quantity").join(members, "member")
    return doses.groupBy("cohort_id").agg(F.count("*").alias("n_doses"), F.sum("l_quantity").alias("total"))


@query("validity_overlap_join", "E22", """
    SELECT a.l_orderkey, a.l_linenumber::BIGINT AS l_linenumber, s.o_orderkey AS stay FROM (SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_returnflag = 'R') a
    JOIN orders s ON s.o_custkey = a.o_custkey AND a.l_shipdate <= s.o_orderdate + INTERVAL 30 DAY AND a.l_shipdate + INTERVAL 45 DAY >= s.o_orderdate
""")
def validity_overlap_join(t):
    persons = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person"))
    allergy = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", line(), F.col("l_shipdate").alias("created"), offset("l_shipdate", 45, "days").alias("ended")).join(persons, "l_orderkey")
    out = joins.overlap_join(allergy, _stays(t).withColumnRenamed("o_orderkey", "stay"), ["person"], "created", "ended", "stay_start", "stay_stop")
    return out.select("l_orderkey", "l_linenumber", "stay")


@query("person_join_then_time_filter", "E23 C13", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, s.o_orderkey AS encounter FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey JOIN orders s ON s.o_custkey = o.o_custkey
    WHERE l_shipdate BETWEEN s.o_orderdate - INTERVAL 24 HOUR AND s.o_orderdate + INTERVAL 240 HOUR
""")
def person_join_then_time_filter(t):
    spans = t.orders.select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("encounter"), "o_orderdate")
    spans = spans.withColumns({"lo": offset("o_orderdate", -24), "hi": offset("o_orderdate", 240)})
    out = joins.interval_join(_doses_by_person(t), spans, ["person"], "l_shipdate", "lo", "hi")
    return out.filter(around("l_shipdate", "o_orderdate", 24, 240)).select("l_orderkey", "l_linenumber", "encounter")


@query("rolling_self_join", "E24 G10", """
    SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS max_24h FROM events
""")
def rolling_self_join(t):
    return rolling(t.events, ["user_id"], "ts", "value", 24, "max", "max_24h").select("event_id", "max_24h")


@query("part_of_total", "E25", """
    SELECT event_id, round(value / nullif(sum(value) OVER (PARTITION BY user_id), 0), 9) AS share FROM events
""")
def part_of_total_query(t):
    out = part_of_total(t.events, ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", F.round("share", 9).alias("share"))


@query("reconcile_populations", "E26", """
    SELECT coalesce(a.k, b.k) AS o_custkey, CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'both' END AS status
    FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 300000) b ON a.k = b.k
""")
def reconcile_populations(t):
    return joins.reconcile(t.orders.filter("o_orderstatus = 'F'"), t.orders.filter("o_totalprice > 300000"), ["o_custkey"])


@query("order_product_chain", "E27", """
    SELECT p_brand, l_returnflag, count(DISTINCT l_orderkey) AS n_orders FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    WHERE l_linenumber = 1 AND p_type IN ('PROMO', 'STANDARD') AND s_acctbal > 0 GROUP BY 1, 2
""")
def order_product_chain(t):
    products = t.part.filter(F.col("p_type").isin("PROMO", "STANDARD")).select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    makers = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    rows = t.lineitem.filter("l_linenumber = 1").join(products, "l_partkey").join(makers, "l_suppkey")
    return rows.groupBy("p_brand", "l_returnflag").agg(F.count_distinct("l_orderkey").alias("n_orders"))


@query("hours_to_next_encounter", "E16 G1", f"""
    SELECT o_orderkey, {hours("o_orderdate", "lead(o_orderdate) OVER w")} AS hours_to_next FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def hours_to_next_encounter(t):
    from ..operators.series import neighbours

    out = neighbours(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], nxt=("lead", "o_orderdate"))
    return out.select("o_orderkey", elapsed("o_orderdate", "nxt", "hours").alias("hours_to_next"))
