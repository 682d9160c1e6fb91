import datetime as dt
import os

import pytest

from wardflow.schema import EXTRACTS, TABLES, schema
from wardflow.sources import read, write


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_times_are_read_in_their_zone(spark, tmp_path, rows):
    path = put(tmp_path, "v.csv", "FIN,Event Datetime,Result\n007,2024-01-01 00:00:00,5\n008,2024-07-01 00:00:00,\n")
    out = read.read_delimited(spark, path, "FIN STRING, `Event Datetime` TIMESTAMP, Result DOUBLE", zone="America/Chicago")
    assert out.columns == ["fin", "event_datetime", "result"]
    assert rows(out) == [("007", "2024-01-01 06:00:00", 5.0), ("008", "2024-07-01 05:00:00", None)]


def test_preamble_and_header_are_dropped(spark, tmp_path, rows):
    path = put(tmp_path, "r.csv", "Report of doses\nrun by, someone, else, and more\nmrn,when,dose\n12,2024-01-01 10:00:00,NA\n13,2024-01-02 10:00:00,4.5\n")
    out = read.read_after_preamble(spark, path, "mrn BIGINT, ts TIMESTAMP, dose DOUBLE", key="mrn")
    assert rows(out) == [(12, "2024-01-01 10:00:00", None), (13, "2024-01-02 10:00:00", 4.5)]


def test_files_of_two_layouts_and_an_empty_one(spark, tmp_path, rows):
    put(tmp_path, "a_1.csv", "id,x\n1,1.5\n")
    put(tmp_path, "a_2.csv", "id,x\n")
    put(tmp_path, "b_1.csv", "id,y\n2,hi\n")
    out = read.read_stacked(spark, [(f"{tmp_path}/a_*.csv", "id INT, x DOUBLE"), (f"{tmp_path}/b_*.csv", "id INT, y STRING")])
    assert rows(out) == [(1, 1.5, None), (2, None, "hi")]


def test_newest_and_all_snapshots(spark, tmp_path, rows):
    put(tmp_path, "pts_2024-01-01.csv", "id,x\n1,1\n2,2\n")
    put(tmp_path, "pts_2024-01-08.csv", "id,x\n2,20\n")
    put(tmp_path, "other.csv", "id,x\n9,9\n")
    stamp = r"pts_(\d{4}-\d{2}-\d{2})"
    assert rows(read.read_newest(spark, str(tmp_path), "pts_*.csv", stamp, "id INT, x INT")) == [(2, 20, "2024-01-08")]
    assert len(rows(read.read_all_snapshots(spark, str(tmp_path), "pts_*.csv", stamp, "id INT, x INT"))) == 3
    with pytest.raises(FileNotFoundError):
        read.read_newest(spark, str(tmp_path), "none_*.csv", stamp, "id INT, x INT")


def test_bundle_replaces_earlier_output(spark, tmp_path):
    df = spark.range(3)
    paths = write.write_bundle({"a": df, "b": df.limit(1)}, str(tmp_path))
    write.write_bundle({"a": df}, str(tmp_path))
    assert spark.read.parquet(paths["a"]).count() == 3 and spark.read.parquet(paths["b"]).count() == 1


def test_dated_targets(spark, tmp_path):
    day = dt.date(2024, 2, 3)
    assert write.dated(str(tmp_path), "icu", day).endswith("/icu_2024-02-03")
    write.write_run(spark.range(2), str(tmp_path / "t"), day)
    write.write_run(spark.range(5), str(tmp_path / "t"), dt.date(2024, 2, 4))
    write.write_run(spark.range(1), str(tmp_path / "t"), day)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_csv_has_a_header_and_no_row_names(spark, tmp_path):
    path = write.write_csv(spark.range(1).withColumnRenamed("id", "fin"), str(tmp_path / "c"))
    parts = [open(os.path.join(path, f)).read().split("\n") for f in os.listdir(path) if f.startswith("part")]
    assert {p[0] for p in parts} == {"fin"}
    assert [line for p in parts for line in p[1:] if line] == ["0"]


def test_schemas_parse():
    assert all(len(schema(n)) > 0 for n in {**TABLES, **EXTRACTS})
