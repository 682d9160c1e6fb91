"""Readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clean_name, rename_all, to_utc

Schema = T.StructType | str


def _struct(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_table(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """Parquet table; the schema is given or taken from the file footers."""
    reader = spark.read if schema is None else spark.read.schema(_struct(schema))
    return reader.parquet(path)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: Schema, zone: str | None = None,
                   pattern: str | None = None, null: str = "", header: bool = True, sep: str = ",") -> DataFrame:
    """Delimited files with a header; names in lower case, naive times read in ``zone``.

    ``path`` may be a folder and ``pattern`` a file-name glob; files without
    rows add nothing.
    """
    shape = _struct(schema)
    reader = spark.read.schema(shape).option("header", header).option("sep", sep).option("nullValue", null)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    out = rename_all(reader.csv(path), clean_name)
    if zone:
        times = [clean_name(f.name) for f in shape if isinstance(f.dataType, T.TimestampType)]
        out = out.withColumns({c: to_utc(c, zone) for c in times})
    return out


def read_after_preamble(spark: SparkSession, path: str | Sequence[str], schema: Schema, key: str, null: str = "NA", sep: str = ",") -> DataFrame:
    """Report exports: title lines, then rows without a usable header.

    Names and types are supplied; lines whose ``key`` has a value that is not of
    its type (the preamble and any header) are dropped, so files can still be
    split.  A row with an unknown key is a row if another of its typed fields, or
    any field where all are text, has a value.
    """
    shape = _struct(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in shape])
    raw = spark.read.schema(text).option("nullValue", null).option("sep", sep).option("mode", "PERMISSIVE").csv(path)
    others = [f for f in shape if f.name != key]
    telling = [f for f in others if not isinstance(f.dataType, T.StringType)] or others
    known = F.coalesce(*[F.col(f.name).try_cast(f.dataType).cast("string") for f in telling]).isNotNull() if telling else F.lit(False)
    row = F.col(key).try_cast(shape[key].dataType).isNotNull() | (F.col(key).isNull() & known)
    return raw.filter(row).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in shape])


def list_stamps(spark: SparkSession, folder: str, pattern: str, stamp: str) -> DataFrame:
    """Paths in ``folder`` with the stamp found in them; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(folder).select("path", F.regexp_extract("path", stamp, 1).alias("stamp")).filter(F.col("stamp") != "")


def read_all_snapshots(spark: SparkSession, folder: str, pattern: str, stamp: str, schema: Schema, zone: str | None = None) -> DataFrame:
    """Every snapshot stacked, each row with the stamp in its path as ``snapshot``."""
    shape = _struct(schema)
    reader = spark.read.schema(shape).option("header", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    rows = reader.csv(folder).select("*", F.regexp_extract(F.col("_metadata.file_path"), stamp, 1).alias("snapshot"))
    out = rename_all(rows, clean_name)
    if zone:
        times = [clean_name(f.name) for f in shape if isinstance(f.dataType, T.TimestampType)]
        out = out.withColumns({c: to_utc(c, zone) for c in times})
    return out


def read_newest(spark: SparkSession, folder: str, pattern: str, stamp: str, schema: Schema, zone: str | None = None) -> DataFrame:
    """The snapshot with the highest stamp.

    The stamp is looked up from the file listing first, so the filter on it is
    a literal and older files are not opened.
    """
    newest = list_stamps(spark, folder, pattern, stamp).agg(F.max("stamp")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no {pattern} with a stamp in {folder}")
    return read_all_snapshots(spark, folder, pattern, stamp, schema, zone).filter(F.col("snapshot") == newest)


def read_stacked(spark: SparkSession, sources: Sequence[tuple[str, Schema]], zone: str | None = None) -> DataFrame:
    """Files of several layouts, ``(path or glob, schema)`` each, stacked by name; missing columns are NULL."""
    parts = [read_delimited(spark, path, schema, zone) for path, schema in sources]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
