"""Helpers shared by the text operators: work tables, word hashes, sampling."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes per Arrow batch: texts may be long, so batches are kept short.
ARROW_ROWS = 1000
ARROW_BYTES = 64 << 20


def tune(spark: SparkSession) -> None:
    """Small Arrow batches for text columns, and skewed joins split at run time."""
    for name, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS)),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES)),
        ("spark.sql.adaptive.enabled", "true"),
        ("spark.sql.adaptive.skewJoin.enabled", "true"),
        ("spark.sql.adaptive.forceOptimizeSkewedJoin", "true"),
    ):
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it; a temporary one only where it is unset (one machine)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.wardflow.llm.folder", None)
        if not folder:
            folder = tempfile.mkdtemp(prefix="wardflow-llm-")
            spark.conf.set("spark.wardflow.llm.folder", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table of the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_buckets(df: DataFrame, key: str, name: str) -> DataFrame:
    """As ``written``, in buckets by ``key``: grouping the result by the key needs no shuffle."""
    spark = df.sparkSession
    name = f"llm_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("compression", "zstd").option("path", f"{work_folder(spark)}/{name}").saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved now: only the files are needed from here on
    spark.sql(f"DROP TABLE {name}")
    return table


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def per_text(start: Callable[[], Callable[[str | None], tuple]], shape: str, *cols: Column) -> Column:
    """A struct column computed from each text by the function that ``start()`` returns, in Arrow batches.

    ``start`` runs once per task, so caches and tables live as long as the task.  Other columns stay in the JVM, so
    ids are exact whatever their type and nulls.
    """
    names = [field.strip().split(" ")[0] for field in shape.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = start()
        for batch in batches:
            out = list(zip(*map(one, batch))) or [()] * len(names)
            yield pd.DataFrame({name: pd.Series(list(values), dtype=object) for name, values in zip(names, out)})

    # Marked so that a filter on the result is not evaluated by running the function again.
    return F.pandas_udf(run, shape).asNondeterministic()(*cols)


def share(df: DataFrame, rows: int) -> float:
    """The fraction that makes a Bernoulli sample of about ``rows`` rows."""
    return min(1.0, rows / max(1, df.count()))


class WordHash(dict):
    """Word (bytes) to its 64-bit hash; the cache empties itself when it holds ``limit`` words."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of ``size`` consecutive words, in order."""
    n = len(hashes) - size + 1
    out = np.full(n, np.uint64(size), np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
        out ^= out >> np.uint64(29)
    return mixed(out)
