"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when a later aggregate on the same key
    # then needs one more exchange: that exchange only carries partial results.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = 8, memory: str = "8g", app: str = "wardflow") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint folder.

    Only where the cluster names none (tests on one machine) is a temporary
    folder made, and remembered for the rest of the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.wardflow.folder", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="wardflow-")
        spark.conf.set("spark.wardflow.folder", folder)
    return folder
