"""Explicit schemas: no read in this library infers types.

Identifiers stay text or BIGINT, instants are TIMESTAMP in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

# Extract-shaped inputs of the tidy stage.
EXTRACTS = {
    "demographics": "encntr_id STRING, fin STRING, age INT, sex STRING, race STRING, weight DOUBLE, los DOUBLE, "
    "arrive_datetime TIMESTAMP, admit_datetime TIMESTAMP, disch_datetime TIMESTAMP, disch_disposition STRING",
    "labs_vitals": "encntr_id STRING, fin STRING, event_id STRING, event_datetime TIMESTAMP, event STRING, "
    "result_val STRING, result_units STRING, nurse_unit STRING",
    "meds": "encntr_id STRING, fin STRING, order_id STRING, event_id STRING, med_datetime TIMESTAMP, "
    "medication STRING, dose DOUBLE, dose_unit STRING, rate DOUBLE, rate_unit STRING, iv_event STRING, "
    "admin_route STRING, nurse_unit STRING, order_weight STRING, concentration STRING, volume STRING, "
    "freetext_rate STRING",
    "icu_stays": "mrn STRING, icu_start TIMESTAMP, icu_end TIMESTAMP",
    "locations": "encntr_id STRING, unit_count INT, nurse_unit STRING, unit_los DOUBLE, "
    "unit_in_datetime TIMESTAMP, unit_out_datetime TIMESTAMP",
    "ins_outs": "fin STRING, event_id STRING, event_datetime TIMESTAMP, event STRING, io_type STRING, "
    "io_volume DOUBLE",
    "transfusions": "encntr_id STRING, fin STRING, event_datetime TIMESTAMP, event STRING, product STRING, "
    "volume DOUBLE, vol_units STRING",
    "vent_events": "encntr_id STRING, event STRING, result_datetime TIMESTAMP, event_datetime TIMESTAMP",
    "cultures": "mrn STRING, specimen_id STRING, lab_datetime TIMESTAMP, lab STRING, value STRING",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL({**TABLES, **EXTRACTS}[name])


class Tables:
    """Attribute access to the tables of one folder: ``Tables(spark, dir).events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.schema(schema(name)).parquet(f"{self.folder}/{name}.parquet")
