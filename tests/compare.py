"""Side-by-side check of a registered query and its SQL."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLE_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo is None else v.tz_convert("UTC").tz_localize(None).isoformat()
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None))


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None when equal, otherwise what differs first."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    kinds = [
        (c, str(actual[c].dtype), str(expected[c].dtype))
        for c in sorted(actual.columns)
        if actual[c].dtype.kind != expected[c].dtype.kind and not (actual[c].isna().any() or expected[c].isna().any() or actual.empty)
    ]
    if kinds:
        return f"types {kinds}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)} rows"
    a, b = rows_of(actual), rows_of(expected)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ of {len(a)}, columns {sorted(actual.columns)}, e.g. {bad[0][0]} != {bad[0][1]}"
    return None


def check(spark, con, name: str, folder: str) -> str | None:
    from wardflow.plans import REGISTRY, run

    actual = run(name, spark, folder).toPandas()
    sql = REGISTRY[name].sql
    if sql is None:
        return None
    return difference(actual, con.execute(sql).df())


if __name__ == "__main__":
    from wardflow.plans import REGISTRY
    from wardflow.session import local_session

    args = sys.argv[1:]
    split = "--split" in args  # cut every key above a few rows, to walk the hot-key paths
    args = [a for a in args if a != "--split"]
    folder = args[0]
    names = args[1:] or list(REGISTRY)
    spark = local_session()
    if split:
        spark.conf.set("spark.wardflow.probeBytes", "0")
        spark.conf.set("spark.wardflow.chunkRows", "10")
    con = connect(folder)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            problem = check(spark, con, name, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - begin
        if problem:
            bad += 1
            print(f"BAD  {name} ({took:.1f}s): {problem}", flush=True)
        elif took > 3:
            print(f"slow {name} ({took:.1f}s)", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree", flush=True)
