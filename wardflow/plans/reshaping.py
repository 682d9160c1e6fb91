"""Long and wide forms."""

from pyspark.sql import functions as F

from ..functions.scalar import clean_name
from ..operators import reshape
from .registry import query

TYPES = ["click", "error", "purchase", "signup", "view"]


def _cases(value, prefix="", agg="max"):
    return ", ".join(f"{agg}(CASE WHEN event_type = '{k}' THEN {value} END) AS {prefix}{k}" for k in TYPES)


@query("flag_pivot", "I1", f"SELECT user_id, {_cases('TRUE', 'had_', 'bool_or')} FROM events GROUP BY 1")
def flag_pivot(t):
    return reshape.flag_pivot(t.events, ["user_id"], "event_type", TYPES, "had_")


@query("value_pivot", "I2 D1", f"""
    WITH f AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1)
    SELECT user_id, {", ".join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS {k}_first" for k in TYPES)} FROM f GROUP BY 1
""")
def value_pivot(t):
    return reshape.value_pivot(t.events, ["user_id"], "event_type", TYPES, "value", ["ts", "event_id"], "{name}_first")


@query("multi_value_pivot", "I3", """
    SELECT l_orderkey, min(l_quantity) FILTER (l_returnflag = 'A') AS A_min, max(l_quantity) FILTER (l_returnflag = 'A') AS A_max, min(l_quantity) FILTER (l_returnflag = 'R') AS R_min,
           max(l_quantity) FILTER (l_returnflag = 'R') AS R_max FROM lineitem GROUP BY 1
""")
def multi_value_pivot(t):
    return reshape.measures_pivot(t.lineitem, ["l_orderkey"], "l_returnflag", ["A", "R"], {"min": F.min("l_quantity"), "max": F.max("l_quantity")})


@query("pivot_two_name_columns", "I4", """
    SELECT o_custkey, max(o_totalprice) FILTER (o_orderstatus = 'F' AND year(o_orderdate) = 1996) AS "F_1996", max(o_totalprice) FILTER (o_orderstatus = 'F' AND year(o_orderdate) = 1997) AS "F_1997",
           max(o_totalprice) FILTER (o_orderstatus = 'O' AND year(o_orderdate) = 1996) AS "O_1996" FROM orders GROUP BY 1
""")
def pivot_two_name_columns(t):
    rows = t.orders.withColumn("y", F.year("o_orderdate"))
    return reshape.value_pivot(rows, ["o_custkey"], ["o_orderstatus", "y"], ["F_1996", "F_1997", "O_1996"], "o_totalprice")


@query("fixed_list_pivot", "I5", """
    SELECT p_brand, count(*) FILTER (p_type = 'PROMO') AS promo, count(*) FILTER (p_type = 'STANDARD') AS standard, count(*) FILTER (p_type = 'SMALL') AS small FROM part GROUP BY 1
""")
def fixed_list_pivot(t):
    wide = t.part.groupBy("p_brand").pivot("p_type", ["PROMO", "STANDARD", "SMALL"]).agg(F.count(F.lit(1)))
    return wide.fillna(0).toDF("p_brand", "promo", "standard", "small")


@query("pivot_with_fill", "I6", f"SELECT user_id, {', '.join(f'''coalesce(bool_or(event_type = '{k}'), FALSE) AS {k}''' for k in TYPES)} FROM events GROUP BY 1")
def pivot_with_fill(t):
    return reshape.flag_pivot(t.events, ["user_id"], "event_type", TYPES, fill=False)


@query("wide_to_long", "I7", """
    SELECT l_orderkey, l_partkey, measure, amount FROM (SELECT l_orderkey, l_partkey, l_discount, l_tax FROM lineitem) UNPIVOT (amount FOR measure IN (l_discount, l_tax)) WHERE amount > 0.05
""")
def wide_to_long(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_discount", "l_tax")
    return reshape.to_long(rows, ["l_orderkey", "l_partkey"], ["l_discount", "l_tax"], "measure", "amount", keep=F.col("amount") > 0.05)


@query("split_and_unite", "I9", """
    SELECT c_custkey, split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number, c_mktsegment || '_' || c_nationkey::VARCHAR AS place FROM customer
""")
def split_and_unite(t):
    rows = reshape.split_column(t.customer.drop("c_acctbal"), "c_name", ["kind", "number"], "#")
    return reshape.unite_columns(rows, "place", ["c_mktsegment", "c_nationkey"])


@query("split_cell_to_rows", "I10", """
    SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS entry FROM orders
""")
def split_cell_to_rows(t):
    cell = F.regexp_replace("o_orderpriority", "-", "\r\n")
    return reshape.explode_list(t.orders.select("o_orderkey", cell.alias("cell")), "cell", "entry")


@query("sorted_pivot_names", "I2 B3", """
    SELECT o_custkey, max(o_totalprice) FILTER (o_orderpriority = '1-URGENT') AS price_1_urgent, max(o_totalprice) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS price_4_not_specified FROM orders GROUP BY 1
""")
def sorted_pivot_names(t):
    wide = reshape.value_pivot(t.orders, ["o_custkey"], "o_orderpriority", sorted(["4-NOT SPECIFIED", "1-URGENT"]), "o_totalprice", names="price {name}")
    return wide.toDF(*[clean_name(c) for c in wide.columns])


@query("pivot_round_trip", "I2 I7", """
    SELECT user_id, event_type, max(value) AS value FROM events GROUP BY 1, 2
""")
def pivot_round_trip(t):
    wide = reshape.value_pivot(t.events, ["user_id"], "event_type", TYPES, "value")
    return reshape.to_long(wide, ["user_id"], TYPES, "event_type", "value", keep=F.col("value").isNotNull())
