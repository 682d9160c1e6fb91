"""Sources and sinks."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions.scalar import to_local
from ..operators.joins import restrict_to
from ..operators.pick import pick_last
from ..session import shared_folder
from ..sources.read import read_after_preamble, read_all_snapshots, read_delimited, read_newest, read_stacked, read_table
from ..sources.write import dated, write_bundle, write_csv, write_run
from .registry import query

ZONE = "America/Chicago"


def _new_folder(t, name):
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query("table_scan", "A1", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'
""")
def table_scan(t):
    orders = read_table(t.spark, f"{t.folder}/orders.parquet", t.orders.schema)
    hit = (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")) & (F.col("o_orderstatus") == "F")
    return orders.filter(hit).select("o_orderkey", "o_custkey", "o_totalprice")


@query("csv_scan_local_zone", "A2 A9", """
    SELECT o_orderkey AS order_key, o_orderdate AS admit_datetime, o_orderstatus AS encounter_class FROM orders
""")
def csv_scan_local_zone(t):
    path = _new_folder(t, "orders-csv")
    out = t.orders.select(
        F.col("o_orderkey").alias("Order Key"), to_local("o_orderdate", ZONE).alias("Admit Datetime"), F.col("o_orderstatus").alias("Encounter Class")
    )
    write_csv(out, path)
    shape = "`Order Key` BIGINT, `Admit Datetime` TIMESTAMP, `Encounter Class` STRING"
    return read_delimited(t.spark, path, shape, zone=ZONE)


@query("preamble_skipping_scan", "A3", """
    SELECT l_orderkey AS encntr_id, l_linenumber::BIGINT AS line, l_shipdate AS med_datetime,
           CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS dose
    FROM lineitem
""")
def preamble_skipping_scan(t):
    path = _new_folder(t, "report")
    titles = t.region.select(F.concat(F.lit("Report section: "), "r_name").alias("value"))
    dose = F.when(F.col("l_returnflag") == "N", "NA").otherwise(F.col("l_quantity").cast("string"))
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    rows = t.lineitem.select(F.concat_ws(",", "l_orderkey", "l_linenumber", stamp, dose).alias("value"))
    titles.unionByName(rows).write.mode("overwrite").text(path)
    return read_after_preamble(
        t.spark, path, "encntr_id BIGINT, line BIGINT, med_datetime TIMESTAMP, dose DOUBLE", key="encntr_id"
    )


@query("stacked_files", "A4 H5", """
    SELECT event_id, ts, CASE WHEN event_type = 'click' THEN value END AS value,
           CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS event_type
    FROM events
""")
def stacked_files(t):
    folder = _new_folder(t, "vitals")
    click = F.col("event_type") == "click"
    write_csv(t.events.filter(click).select("event_id", "ts", "value"), f"{folder}/vitals_a")
    write_csv(t.events.filter(~click).select("event_id", "ts", "event_type"), f"{folder}/labs_a")
    # a file with a header and no rows adds nothing
    write_csv(t.events.filter("event_id < 0").select("event_id", "ts", "value").coalesce(1), f"{folder}/vitals_b")
    return read_stacked(t.spark, [
        (f"{folder}/vitals_*", "event_id BIGINT, ts TIMESTAMP, value DOUBLE"),
        (f"{folder}/labs_*", "event_id BIGINT, ts TIMESTAMP, event_type STRING"),
    ])


def _snapshots(t):
    folder = _new_folder(t, "weekly")
    for status, day in (("F", dt.date(2019, 1, 7)), ("O", dt.date(2019, 1, 14)), ("P", dt.date(2019, 1, 21))):
        part = t.orders.filter(F.col("o_orderstatus") == status).select("o_custkey", "o_orderkey", "o_totalprice")
        write_csv(part, dated(folder, "patients", day))
    return folder


_SNAPSHOT = "o_custkey BIGINT, o_orderkey BIGINT, o_totalprice DOUBLE"
_STAMP = r"patients_(\d{4}-\d{2}-\d{2})"


@query("newest_snapshot", "A5 A10", """
    SELECT o_custkey, o_orderkey, o_totalprice, '2019-01-21' AS snapshot FROM orders WHERE o_orderstatus = 'P'
""")
def newest_snapshot(t):
    return read_newest(t.spark, _snapshots(t), "*.csv", _STAMP, _SNAPSHOT)


@query("snapshot_rollup", "A6 D6", """
    SELECT o_custkey, o_orderkey, o_totalprice,
           CASE o_orderstatus WHEN 'F' THEN '2019-01-07' WHEN 'O' THEN '2019-01-14' ELSE '2019-01-21' END AS snapshot
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY snapshot DESC, o_orderkey DESC) = 1
""")
def snapshot_rollup(t):
    rows = read_all_snapshots(t.spark, _snapshots(t), "*.csv", _STAMP, _SNAPSHOT)
    return pick_last(rows, ["o_custkey"], ["snapshot", "o_orderkey"])


@query("restrict_to_id_list", "A7 E6", """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def restrict_to_id_list(t):
    ids = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return restrict_to(t.orders, ids, "o_custkey").select("o_orderkey", "o_custkey", "o_orderdate")


@query("named_bundle_sink", "A8", """
    SELECT 'doses' AS table_name, l_returnflag AS label, count(*) AS n, round(sum(l_quantity), 2) AS total
    FROM lineitem GROUP BY l_returnflag
    UNION ALL
    SELECT 'encounters', o_orderstatus, count(*), round(sum(o_totalprice), 2) FROM orders GROUP BY o_orderstatus
""")
def named_bundle_sink(t):
    doses = t.lineitem.select(F.col("l_returnflag").alias("label"), F.col("l_quantity").alias("x"))
    encounters = t.orders.select(F.col("o_orderstatus").alias("label"), F.col("o_totalprice").alias("x"))
    paths = write_bundle({"doses": doses, "encounters": encounters}, _new_folder(t, "bundle"))
    parts = [
        read_table(t.spark, path, "label STRING, x DOUBLE")
        .groupBy(F.lit(name).alias("table_name"), "label")
        .agg(F.count("*").alias("n"), F.round(F.sum("x"), 2).alias("total"))
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query("dated_output", "A10", """
    SELECT n_nationkey::BIGINT AS n_nationkey, n_name, count(c_custkey) AS n_customers, TIMESTAMP '2019-02-01' AS run_date
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL
""")
def dated_output(t):
    path = _new_folder(t, "counts")
    per_nation = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    out = t.nation.join(per_nation, "n_nationkey", "left").select(
        F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_customers")
    )
    write_run(out, path, dt.date(2019, 2, 1))
    return read_table(t.spark, path, "n_nationkey BIGINT, n_name STRING, n_customers BIGINT, run_date DATE").withColumn("run_date", F.col("run_date").cast("timestamp"))
