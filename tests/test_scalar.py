import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardflow.functions import predicates as P
from wardflow.functions import scalar as S


def one(spark, column, **values):
    base = spark.range(1)
    for name, v in values.items():
        base = base.withColumn(name, v if not isinstance(v, (str, int, float, type(None))) else F.lit(v))
    return base.select(column.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize("text,expected", [
    ("<3", (3.0, True, False)), (">600", (600.0, False, True)), ("1,200", (1200.0, False, False)), ("See Note", (None, False, False)),
    ("7.25", (7.25, False, False)), (" 12 ", (12.0, False, False)), ("-4", (-4.0, False, False)), ("12 mg", (None, False, False)), ("", (None, False, False)),
    ("1e5", (None, False, False)), ("NaN", (None, False, False)),
])
def test_parse_result(spark, text, expected):
    assert tuple(one(spark, S.parse_result(F.lit(text)))) == expected


def test_parse_result_of_null(spark):
    assert tuple(one(spark, S.parse_result(F.lit(None).cast("string")))) == (None, None, None)


def test_zone_conversion_across_clock_changes(spark):
    zone = "US/Central"
    assert one(spark, S.to_local(ts("2024-03-10 07:59:00"), zone)) == dt.datetime(2024, 3, 10, 1, 59)
    assert one(spark, S.to_local(ts("2024-03-10 08:00:00"), zone)) == dt.datetime(2024, 3, 10, 3, 0)
    assert one(spark, S.to_local(ts("2024-11-03 06:30:00"), zone)) == dt.datetime(2024, 11, 3, 1, 30)
    assert one(spark, S.to_local(ts("2024-11-03 07:30:00"), zone)) == dt.datetime(2024, 11, 3, 1, 30)
    assert one(spark, S.to_utc(ts("2024-07-01 00:00:00"), zone)) == dt.datetime(2024, 7, 1, 5, 0)


@pytest.mark.parametrize("mode,clip,base,expected", [
    ("floor", None, 0, -1), ("ceil", None, 0, 0), ("trunc", None, 0, 0), ("calendar", None, 0, -1), ("floor", 0, 0, 0), ("floor", 0, 1, 1),
])
def test_hosp_day_before_admission(spark, mode, clip, base, expected):
    assert one(spark, S.hosp_day(ts("2024-01-01 20:00:00"), ts("2024-01-02 08:00:00"), mode, clip, base)) == expected


def test_hosp_day_on_the_edge(spark):
    assert one(spark, S.hosp_day(ts("2024-01-03 08:00:00"), ts("2024-01-02 08:00:00"))) == 1
    assert one(spark, S.hosp_day(ts("2024-01-03 07:59:59"), ts("2024-01-02 08:00:00"))) == 0
    assert one(spark, S.hosp_day(ts("2024-01-03 00:00:00"), ts("2024-01-02 23:59:59"), "calendar")) == 1


def test_shift_day_and_fiscal_year(spark):
    assert one(spark, S.shift_day(ts("2024-01-02 06:59:59"))) == dt.datetime(2024, 1, 1)
    assert one(spark, S.shift_day(ts("2024-01-02 07:00:00"))) == dt.datetime(2024, 1, 2)
    assert one(spark, S.fiscal_year(ts("2023-06-30 12:00:00"))) == dt.datetime(2023, 1, 1)
    assert one(spark, S.fiscal_year(ts("2023-07-01 00:00:00"))) == dt.datetime(2024, 1, 1)


def test_minimum_of_columns(spark):
    null = F.lit(None).cast("int")
    assert one(spark, S.least_known(F.lit(3), null)) == 3
    assert one(spark, S.least_strict(F.lit(3), null)) is None
    assert one(spark, S.least_known(null, null)) is None


def test_three_way_if(spark):
    flag = F.lit(None).cast("boolean")
    assert one(spark, S.if_missing_aware(flag, F.lit("y"), F.lit("n"), F.lit("?"))) == "?"
    assert one(spark, S.if_missing_aware(F.lit(False), F.lit("y"), F.lit("n"), F.lit("?"))) == "n"


def test_decode_matches_null(spark):
    assert one(spark, S.decode(F.lit(None).cast("string"), {"a": 1, None: 2}, 3)) == 2
    assert one(spark, S.decode(F.lit("z"), {"a": 1, None: 2}, 3)) == 3


def test_classify_takes_the_first_match(spark):
    ordered = {"norepinephrine": "norepi", "epinephrine": "epi"}
    assert one(spark, S.classify(F.lit("norepinephrine drip"), ordered)) == "norepinephrine"
    assert one(spark, S.classify(F.lit("epinephrine"), ordered)) == "epinephrine"
    assert one(spark, S.classify(F.lit("saline"), ordered)) is None


def test_repair_account_id(spark):
    assert one(spark, S.repair_account_id(F.lit("123456787"))) == "123456780007"
    assert one(spark, S.repair_account_id(F.lit("123456781234"))) == "123456781234"


@pytest.mark.parametrize("rate,unit,dose,dose_unit,expected", [
    (6.0, "mg/hr", None, None, 6 * 1000 / 60 / 50), (6.0, "microgram/kg/min", None, None, 6.0), (6.0, "mg/kg/min", None, None, 6000.0),
    (None, None, 30.0, "mg", 30 * 1000 / 60 / 50), (None, None, 10.0, "mL", 10 * 75 / 100 * 1000 / 60 / 50), (6.0, "odd unit", None, None, 6.0),
    (None, "mg/hr", 30.0, "mg", None), (None, None, 3.0, "units", None),
])
def test_normalize_rate(spark, rate, unit, dose, dose_unit, expected):
    def lit(v, kind):
        return F.lit(v).cast(kind)

    got = one(spark, S.normalize_rate(lit(rate, "double"), lit(unit, "string"), F.lit(50.0), lit(dose, "double"), lit(dose_unit, "string"), F.lit(75.0), F.lit(100.0)))
    assert got is None if expected is None else got == pytest.approx(expected)


def test_age_by_365_25_days(spark):
    born = F.lit("2000-01-01").cast("date")
    assert one(spark, S.age_years(born, ts("2018-01-01 00:00:00"))) == 18  # 6575 days
    assert one(spark, S.age_years(born, ts("2017-12-31 00:00:00"))) == 17
    assert one(spark, P.adult(born, ts("2018-01-01 00:00:00"))) is True


AS_OF = dt.datetime(2024, 3, 13, 15, 0, tzinfo=dt.timezone.utc)  # a Wednesday


@pytest.mark.parametrize("preset,lo,hi", [
    ("Today", "2024-03-13T05:00:00", "2024-03-14T04:59:59"), ("Yesterday", "2024-03-12T05:00:00", "2024-03-13T04:59:59"),
    ("Week to Date", "2024-03-10T06:00:00", "2024-03-13T04:59:59"), ("Last Week", "2024-03-03T06:00:00", "2024-03-10T05:59:59"),
    ("Last Month", "2024-02-01T06:00:00", "2024-03-01T05:59:59"), ("Month to Date", "2024-03-01T06:00:00", "2024-03-13T04:59:59"),
    ("N Days Prior", "2024-03-06T16:00:00", "2024-03-13T15:00:00"),
])
def test_date_presets_across_the_spring_change(preset, lo, hi):
    got = P.date_range(preset, AS_OF, "America/Chicago", days=7)
    assert [t.strftime("%Y-%m-%dT%H:%M:%S") for t in got] == [lo, hi]


def test_week_start_is_a_parameter():
    lo, _ = P.date_range("Week to Date", AS_OF, "UTC", week_start=0)
    assert lo.date() == dt.date(2024, 3, 11)


def test_long_code_lists_become_a_join(spark, frame, rows):
    df = frame("code int, x string", [(1, "a"), (2, "b"), (None, "c"), (70, "d")])
    assert rows(P.in_codes(df, "code", range(60))) == [(1, "a"), (2, "b")]
    assert [r[1] for r in rows(P.in_codes(df, "code", range(60), keep=False))] == ["c", "d"]
    assert [r[1] for r in rows(P.in_codes(df, "code", [1, 2], keep=False))] == ["c", "d"]


def test_current_version(frame, rows):
    df = frame("id int, until timestamp, active int", [(1, "2100-12-31", 1), (2, "2020-01-01", 1), (3, "2100-12-31", 0)])
    assert rows(df.filter(P.current_version("until", "active")), "id") == [(1,)]


def test_plausible_band_is_strict(frame, rows):
    df = frame("x double", [(40.0,), (41.0,), (250.0,), (None,)])
    assert rows(df.filter(P.plausible("x", 40, 250))) == [(41.0,)]


def test_column_helpers(frame):
    df = frame("`Lab Name` string, lab_value int, Lab_unit string", [("a", 1, "u")])
    clean = S.rename_all(df, S.clean_name)
    assert clean.columns == ["lab_name", "lab_value", "lab_unit"]
    assert S.columns_like(clean, starts="lab", ends="e") == ["lab_name", "lab_value"]
    assert S.columns_like(clean, contains="val") == ["lab_value"]
