"""Writers: named bundles of result tables, CSV, dated targets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_bundle(tables: Mapping[str, DataFrame], folder: str, format: str = "parquet", mode: str = "overwrite", **options) -> dict[str, str]:
    """Write each table to ``folder/name``; returns the paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        df.write.mode(mode).format(format).options(**options).save(paths[name])
    return paths


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, null: str = "") -> str:
    df.write.mode(mode).option("header", header).option("nullValue", null).option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
    ).csv(path)
    return path


def dated(folder: str, name: str, day: dt.date) -> str:
    """Target path that carries the run date."""
    return f"{folder.rstrip('/')}/{name}_{day:%Y-%m-%d}"


def write_run(df: DataFrame, path: str, day: dt.date) -> str:
    """Write under ``path/run_date=…``, replacing only that run."""
    target = f"{path.rstrip('/')}/run_date={day:%Y-%m-%d}"
    df.write.mode("overwrite").parquet(target)
    return target


def write_bucketed(df: DataFrame, table: str, on, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as a table in buckets of ``on``, sorted within them, and read it back.

    Tables with the same key and number of buckets are joined and grouped by the
    key without an exchange, so parts that many reports assemble are moved once.
    """
    on = [on] if isinstance(on, str) else list(on)
    writer = df.repartition(buckets, *on).write.mode("overwrite").bucketBy(buckets, *on).sortBy(*on)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
