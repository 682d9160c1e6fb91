"""Clinical features: composites of the other operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import around
from ..functions.scalar import DOSE_UNITS, classify, dose_per_weight, elapsed, offset, shift_day
from .joins import asof_join, first_state
from .reshape import flag_pivot, value_pivot
from .series import stays
from .skew import crowded_keys, is_small


def baseline_value(df: DataFrame, keys, ts: str, anchor: str, code: str, value: str, codes: Sequence[str],
                   before: float, after: float, tie=(), names: str = "{name}_admit") -> DataFrame:
    """First value of each code within the hours around the anchor, one column per code."""
    rows = df.filter(around(ts, anchor, before, after))
    return value_pivot(rows, keys, code, codes, value, order=[ts, *tie], names=names)


def timed_snapshots(df: DataFrame, keys, ts: str, anchor: str, code: str, value: str, target_h: float = 24.0, tie=()) -> DataFrame:
    """Value at admission (first), nearest to ``target_h`` and at discharge (last), stacked with a timing label.

    One aggregate for the three picks; the stack is an expansion of its row.
    """
    place = F.struct(ts, *tie)
    gap = F.abs(F.unix_micros(ts) - F.unix_micros(anchor) - F.lit(int(target_h * 3_600_000_000)))
    both = F.struct(F.col(ts).alias("at"), F.col(value).alias("v"))
    one = df.groupBy(*keys, code).agg(
        F.min_by(both, place).alias("ADMIT"),
        F.min_by(both, F.struct(gap.alias("g"), ts, *tie)).alias(f"HR{int(target_h)}"),
        F.max_by(both, place).alias("DISCH"),
    )
    rows = F.inline(F.array(*[
        F.struct(F.lit(t).alias("timing"), F.col(t)["at"].alias("at"), F.col(t)["v"].alias(value))
        for t in ("ADMIT", f"HR{int(target_h)}", "DISCH")
    ]))
    return one.select(*keys, code, rows)


def icu_los(history: DataFrame, keys, start: str, stop: str, unit: str, units: Sequence[str], tie, until=None) -> DataFrame:
    """Days, first entry and last exit over the listed units."""
    per_stay = stays(history, keys, start, stop, unit, tie, until).filter(F.col(unit).isin(list(units)))
    return per_stay.groupBy(*keys).agg(
        F.sum("unit_los").alias("icu_los"), F.min("unit_in_datetime").alias("icu_start"), F.max("unit_out_datetime").alias("icu_stop")
    )


def admit_unit(rows: DataFrame, keys, order, unit: str, skip: Sequence[str] = (), targets: Sequence[str] | None = None) -> DataFrame:
    """First unit after admission; emergency and holding units are passed over."""
    return first_state(rows, keys, order, unit, skip, targets).select(*keys, F.col(unit).alias("admit_unit"))


def io_balance(df: DataFrame, keys, ts: str, io_type: str, volume: str, catheter: Column, day: str = "calendar", shift_start: float = 7) -> DataFrame:
    """In, out and net volume and a catheter flag per key and (calendar or shift) day."""
    date = F.date_trunc("day", F.col(ts)) if day == "calendar" else shift_day(ts, shift_start)
    is_in, is_out = F.lower(F.col(io_type)) == "in", F.lower(F.col(io_type)) == "out"
    v = F.col(volume)
    out = df.groupBy(*keys, date.alias("event_date")).agg(
        F.sum(F.when(is_in, v)).alias("io_in"),
        F.coalesce(F.sum(F.when(is_out, v)), F.lit(0.0)).alias("io_out"),
        F.coalesce(F.max(F.when(is_out, catheter)), F.lit(False)).alias("catheter"),
    )
    return out.withColumn("io_net", F.col("io_in") - F.col("io_out"))


# Product class -> pattern of the product text.
BLOOD_PRODUCTS = {"whole": "WB", "prbc": "RBC", "ffp": "Plasma|FFP", "platelets": "PHP|Plts", "cryo": "Cryo"}


def blood_products(issued: DataFrame, charted: DataFrame, keys, ts: str, anchor: str, product: str, volume: str,
                   within_h: float = 4.0, classes: Mapping[str, str] = BLOOD_PRODUCTS) -> DataFrame:
    """Volume per product class up to ``within_h`` after the anchor from two sources, and a flag per class.

    A class was given when it was issued at all or charted with a volume above zero.
    """
    cols = [*keys, ts, anchor, product, volume]
    rows = issued.select(*cols, F.lit("prod").alias("_source")).unionByName(charted.select(*cols, F.lit("io").alias("_source")))
    return blood_products_by_source(rows, keys, ts, anchor, product, volume, "_source", "prod", "io", within_h, classes)


def blood_products_by_source(rows: DataFrame, keys, ts: str, anchor: str, product: str, volume: str, source: str, issued, charted,
                             within_h: float = 4.0, classes: Mapping[str, str] = BLOOD_PRODUCTS) -> DataFrame:
    """As :func:`blood_products`, of rows that name their source: one pass and one aggregate."""
    rows = rows.filter(F.col(ts) <= offset(anchor, within_h)).withColumn("_class", classify(product, classes))
    rows = rows.filter(F.col("_class").isNotNull() & F.col(source).isin(issued, charted))
    sums = [
        F.sum(F.when((F.col(source) == kind) & (F.col("_class") == c), F.col(volume))).alias(f"{prefix}_{c}")
        for kind, prefix in ((issued, "prod"), (charted, "io")) for c in classes
    ]
    given = {
        f"blood_{c}": F.col(f"prod_{c}").isNotNull() | F.coalesce(F.col(f"io_{c}") > 0, F.lit(False)) for c in classes
    }
    return rows.groupBy(*keys).agg(*sums).withColumns(given)


def no_exposure_before(index: DataFrame, exposures: DataFrame, keys, index_ts: str, ts: str) -> DataFrame:
    """Index rows whose key has no exposure before the index time.

    Only the first exposure of a key matters, so the join sees one row per key.
    """
    first = exposures.groupBy(*keys).agg(F.min(ts).alias("_first"))
    out = index.join(first, list(keys), "left")
    return out.filter(~F.coalesce(F.col("_first") < F.col(index_ts), F.lit(False))).drop("_first")


def prior_therapy(doses: DataFrame, index: DataFrame, keys, ts: str, med: str, index_ts: str, loaded: str,
                  max_gap_days: float = 5.0, load_days: float = 6.0) -> DataFrame:
    """Days on other drugs before the index drug and whether that (or a loading dose) counts as loaded."""
    keys = list(keys)
    asked = index.select(*keys, index_ts, loaded).distinct()
    if not is_small(doses, index) and crowded_keys(asked, doses, keys) == []:
        # Few index rows to a key: its doses meet them once.
        seen = asked.join(doses.select(*keys, med, F.col(ts).alias("_at")), keys).filter(F.col("_at") < F.col(index_ts))
        runs = seen.groupBy(*keys, med, index_ts, loaded).agg(F.min("_at").alias("_start"), F.max("_at").alias("_stop"))
    else:
        runs = _runs_before(asked, doses, keys, ts, med, index_ts)
    runs = runs.withColumns({
        "_days": elapsed("_start", "_stop", "days"), "_gap": elapsed("_stop", index_ts, "days"),
    }).filter(F.col("_gap") < max_gap_days)
    out = runs.groupBy(*keys, loaded).agg(
        F.max_by(med, F.struct("_stop", med)).alias("medication"), F.sum("_days").alias("duration"), F.min("_gap").alias("stop_to_index"),
    )
    long = F.col("duration") > load_days
    return out.withColumns({"full_load": F.col(loaded) | long, "other_load": ~F.col(loaded) & long})


def _runs_before(asked: DataFrame, doses: DataFrame, keys: list[str], ts: str, med: str, index_ts: str) -> DataFrame:
    """First and last dose of each drug before each index row, ``_start`` and ``_stop``."""
    # Per drug its first dose; the last before the index is carried to the index row, so doses never meet index rows.
    first = doses.groupBy(*keys, med).agg(F.min(ts).alias("_start"))
    asked = asked.join(first, keys).filter(F.col("_start") < F.col(index_ts))
    last = doses.select(*keys, med, F.col(ts).alias("_stop"))
    return asof_join(asked, last, [*keys, med], index_ts, "_stop", ["_stop"], strict=True)


def med_after_index(index: DataFrame, doses: DataFrame, keys, ts: str, med: str, meds: Sequence[str], index_times: Sequence[str], prefix: str = "") -> DataFrame:
    """Flag per drug given after any of several index times; every index row is kept."""
    earliest = F.min(F.least(*[F.col(c) for c in index_times])).alias("_index")
    base = index.groupBy(*keys).agg(earliest)
    # Only a drug's last dose decides, so the join sees one row per key on both sides.
    last = doses.filter(F.col(med).isin(list(meds))).groupBy(*keys).agg(*[F.max(F.when(F.col(med) == m, F.col(ts))).alias(f"_last_{i}") for i, m in enumerate(meds)])
    flags = [F.when(F.col(f"_last_{i}") > F.col("_index"), F.lit(True)).alias(f"{prefix}{m}") for i, m in enumerate(meds)]
    return base.join(last, list(keys), "left").select(*keys, *flags)


def culture_positive(cultures: DataFrame, keys, lab: str, text: str, labs: Sequence[str], negative: str = "(?i)no growth|flora",
                     not_counted: Mapping[str, str] | None = None) -> DataFrame:
    """Flag per culture type with a positive result."""
    rows = cultures.filter(~F.col(text).rlike(negative))
    for name, pattern in (not_counted or {}).items():
        rows = rows.filter(~((F.col(lab) == name) & F.col(text).rlike(pattern)))
    return flag_pivot(rows, keys, lab, labs, "positive_")


def drug_class_codes(codes: DataFrame, code: str, display: str, members: DataFrame, name: str) -> DataFrame:
    """Event codes of the drugs listed by name in ``members`` (case-insensitive)."""
    wanted = members.select(F.lower(name).alias("_name")).distinct()
    return codes.withColumn("_name", F.lower(display)).join(wanted, "_name", "left_semi").select(code, display)


def start_time_matrix(doses: DataFrame, keys, ts: str, anchor: str, med: str, meds: Sequence[str], names: str = "{name}_start_hrs") -> DataFrame:
    """Hours from the anchor to the first dose of each drug, one column per drug."""
    hours = elapsed(anchor, ts, "hours")
    cols = [F.min(F.when(F.col(med) == m, hours)).alias(names.format(name=m)) for m in meds]
    return doses.groupBy(*keys).agg(*cols)


def group_counts(df: DataFrame, by, patient: str, name: str = "n_patients") -> DataFrame:
    """Distinct patients per group."""
    return df.groupBy(*by).agg(F.count_distinct(patient).alias(name))


def original_order_id(template: str, order: str) -> Column:
    """Order that a charted dose goes back to: itself, or its template."""
    return F.when(F.col(template) == 0, F.col(order)).otherwise(F.col(template))


def bolus_per_weight(doses: DataFrame, weights: DataFrame, keys, ts: str, dose: str, unit: str, iv_event: str, weight_ts: str, weight: str,
                     weight_tie=(), units: Mapping[str, float] = DOSE_UNITS, name: str = "bolus") -> DataFrame:
    """Bolus doses in microgram/kg, by the last weight at or before the dose.

    A bolus is a charted dose above zero in a listed unit that is no event of an
    infusion; doses of a key without a weight by then are left out.
    """
    given = doses.filter(F.col(iv_event).isNull() & (F.col(dose) > 0) & F.col(unit).isin(list(units)))
    out = asof_join(given, weights, keys, ts, weight_ts, [weight], weight_tie, how="inner")
    return out.withColumn(name, dose_per_weight(dose, unit, weight, units))
