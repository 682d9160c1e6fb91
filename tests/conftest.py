import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from wardflow.session import local_session

    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def split(spark):
    """Every key above a few rows is cut into chunks."""
    spark.conf.set("spark.wardflow.probeBytes", "0")
    spark.conf.set("spark.wardflow.chunkRows", "8")
    yield
    spark.conf.unset("spark.wardflow.probeBytes")
    spark.conf.unset("spark.wardflow.chunkRows")


@pytest.fixture
def frame(spark):
    """``frame("id bigint, ts timestamp", [(1, "2024-01-01 00:00:00")])``: times may be given as text."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def make(ddl, rows):
        shape = T.StructType.fromDDL(ddl)
        text = T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.TimestampType, T.DateType)) else f.dataType) for f in shape
        ])
        return spark.createDataFrame(rows, text).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in shape])

    return make


@pytest.fixture
def rows():
    """Rows as sorted tuples, with times as ISO text and doubles rounded."""
    def cell(v):
        if hasattr(v, "isoformat"):
            return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
        return round(v, 6) if isinstance(v, float) else v

    def read(df, *cols):
        got = [tuple(cell(v) for v in r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(got, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))

    return read
