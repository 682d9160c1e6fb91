"""Dedup, pick-one, sorts and set operations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import elapsed
from ..operators import pick, reshape
from .registry import hours, query


@query("first_row_per_key", "D1 H3", """
    SELECT user_id, event_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def first_row_per_key(t):
    return pick.pick_first(t.events.drop("props"), ["user_id"], ["ts", "event_id"])


@query("last_row_per_key", "D2 H1", """
    SELECT user_id, event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def last_row_per_key(t):
    return pick.pick_last(t.events.drop("props"), ["user_id", "event_type"], ["ts", "event_id"])


@query("head_per_group", "H3", """
    SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3
""")
def head_per_group(t):
    return pick.pick_first(t.events.select("user_id", "event_id", "value"), ["user_id"], [F.desc("value"), "event_id"], n=3)


@query("nearest_to_target_times", "D3", """
    WITH a AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS admit FROM events),
    n AS (SELECT user_id, h, value, abs(epoch_us(ts) - epoch_us(admit) - h * 3600000000) AS d, ts, event_id FROM a, (VALUES (6), (12), (18), (24)) t(h)),
    p AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY user_id, h ORDER BY d, ts, event_id) = 1)
    SELECT user_id, max(CASE WHEN h = 6 THEN value END) AS value_6h, max(CASE WHEN h = 12 THEN value END) AS value_12h,
           max(CASE WHEN h = 18 THEN value END) AS value_18h, max(CASE WHEN h = 24 THEN value END) AS value_24h FROM p GROUP BY user_id
""")
def nearest_to_target_times(t):
    admit = t.events.groupBy("user_id").agg(F.min("ts").alias("admit"))
    rows = t.events.join(admit, "user_id")
    return pick.nearest(rows, ["user_id"], "ts", "admit", [6, 12, 18, 24], ["value"], ["event_id"])


@query("keep_first_and_last_value", "D4", """
    WITH d AS (SELECT o_custkey, o_orderdate, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1, 2)
    SELECT o_custkey, arg_min(lo, o_orderdate) AS first_min, arg_min(hi, o_orderdate) AS first_max, arg_max(lo, o_orderdate) AS last_min, arg_max(hi, o_orderdate) AS last_max
    FROM d GROUP BY o_custkey
""")
def keep_first_and_last_value(t):
    return t.orders.groupBy("o_custkey").agg(
        pick.keep_first("o_totalprice", ["o_orderdate"], "min").alias("first_min"), pick.keep_first("o_totalprice", ["o_orderdate"], "max").alias("first_max"),
        pick.keep_last("o_totalprice", ["o_orderdate"], "min").alias("last_min"), pick.keep_last("o_totalprice", ["o_orderdate"], "max").alias("last_max"),
    )


@query("newest_version_on_every_row", "D5", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_shipdate,
           last_value(l_quantity) OVER w AS l_quantity_newest, last_value(l_returnflag) OVER w AS l_returnflag_newest FROM lineitem
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def newest_version_on_every_row(t):
    out = pick.with_newest(
        t.lineitem, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], ["l_quantity", "l_returnflag"]
    )
    return out.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_shipdate", "l_quantity_newest", "l_returnflag_newest")


@query("one_per_time_bucket", "D6", """
    SELECT user_id, date_trunc('day', ts) AS bucket, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) = 1
""")
def one_per_time_bucket(t):
    return pick.one_per_bucket(t.events.select("user_id", "ts", "event_id", "value"), ["user_id"], "ts", "day", ["ts", "event_id"]).drop("ts")


@query("first_encounter_per_person", "D7", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def first_encounter_per_person(t):
    return pick.pick_first(t.orders.drop("o_orderpriority"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("first_time_condition_holds", "D8", f"""
    SELECT user_id, min(ts) FILTER (value < 10) AS goal, {hours("min(ts)", "min(ts) FILTER (value < 10)")} AS goal_hours FROM events GROUP BY user_id
""")
def first_time_condition_holds(t):
    return pick.first_when(t.events, ["user_id"], "ts", F.col("value") < 10, "goal")


@query("mean_of_top_values", "D9", """
    SELECT l_suppkey, round(avg(l_quantity), 6) AS top_mean FROM (SELECT l_suppkey, l_quantity FROM lineitem QUALIFY rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) <= 3) GROUP BY l_suppkey
""")
def mean_of_top_values(t):
    top = pick.top_mean(t.lineitem, ["l_suppkey"], "l_quantity", 3)
    return top.withColumn("top_mean", F.round("top_mean", 6))


@query("top_rows_with_ties", "D9", """
    SELECT l_suppkey, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM lineitem QUALIFY rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) <= 3
""")
def top_rows_with_ties(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_quantity")
    return pick.pick_first(rows, ["l_suppkey"], ["l_quantity"], 3, ties=True)


@query("keys_with_one_class", "D10", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 1)
""")
def keys_with_one_class(t):
    return pick.single_class(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_custkey"], "o_orderstatus")


@query("code_set_discovery", "D11", "SELECT DISTINCT p_brand, p_type FROM part ORDER BY p_brand, p_type")
def code_set_discovery(t):
    return pick.code_set(t.part, "p_brand", "p_type")


@query("sorted_nulls_last", "H1", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer ORDER BY bal DESC NULLS LAST, c_custkey
""")
def sorted_nulls_last(t):
    bal = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return t.customer.select("c_custkey", bal.alias("bal")).orderBy(F.desc_nulls_last("bal"), "c_custkey")


@query("sorted_within_group", "H2 G12", """
    SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS visit_no FROM orders
""")
def sorted_within_group(t):
    from ..operators.series import sequence_number

    return sequence_number(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "visit_no").drop("o_orderdate")


@query("union_distinct", "H4", """
    SELECT o_custkey AS person_id FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_acctbal > 5000
""")
def union_distinct(t):
    a = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("person_id"))
    b = t.customer.filter(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("person_id"))
    return a.union(b).distinct()


@query("stack_by_name", "H5", """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def stack_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return reshape.stack([a, b])


@query("set_difference", "H6", """
    SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'
""")
def set_difference(t):
    def pairs(flag):
        return t.lineitem.filter(F.col("l_returnflag") == flag).select("l_partkey", "l_suppkey")

    return pairs("R").subtract(pairs("A"))


@query("membership_matrix", "H7", """
    SELECT p AS person_id, bool_or(k = 1) AS final, bool_or(k = 2) AS wealthy, bool_or(k = 3) AS builder FROM (
      SELECT o_custkey AS p, 1 AS k FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey, 2 FROM customer WHERE c_acctbal > 5000
      UNION ALL SELECT c_custkey, 3 FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY p
""")
def membership_matrix(t):
    people = t.customer.withColumnRenamed("c_custkey", "person_id")
    return reshape.membership({
        "final": t.orders.filter(F.col("o_orderstatus") == "F").withColumnRenamed("o_custkey", "person_id"),
        "wealthy": people.filter(F.col("c_acctbal") > 5000), "builder": people.filter(F.col("c_mktsegment") == "BUILDING"),
    }, "person_id")


@query("elapsed_since_first_pick", "D7 J7", """
    SELECT o_orderkey, o_custkey, round((epoch_us(o_orderdate) - epoch_us(min(o_orderdate) OVER (PARTITION BY o_custkey))) / 8.64e10, 6) AS days_since_first FROM orders
""")
def elapsed_since_first_pick(t):
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    return t.orders.join(first, "o_custkey").select("o_orderkey", "o_custkey", F.round(elapsed("first", "o_orderdate", "days"), 6).alias("days_since_first"))
