"""Column helpers: time arithmetic, text cleaning, result parsing, classification."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str

MICROS = {"seconds": 1e6, "minutes": 6e7, "hours": 3.6e9, "days": 8.64e10, "weeks": 6.048e11}


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------- time

def elapsed(start: ColumnLike, stop: ColumnLike, unit: str = "hours") -> Column:
    """``stop - start`` as a double in ``unit``; negative when stop is earlier."""
    return (F.unix_micros(col(stop)) - F.unix_micros(col(start))) / F.lit(MICROS[unit])


def offset(ts: ColumnLike, amount: float, unit: str = "hours") -> Column:
    """``ts`` moved by a possibly fractional amount."""
    return F.timestamp_micros(F.unix_micros(col(ts)) + F.lit(int(round(amount * MICROS[unit]))))


def to_local(ts: ColumnLike, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC instant."""
    return F.from_utc_timestamp(col(ts), zone)


def to_utc(ts: ColumnLike, zone: str) -> Column:
    """UTC instant of a wall-clock time in ``zone``."""
    return F.to_utc_timestamp(col(ts), zone)


def iso_text(ts: ColumnLike) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def parse_time(text: ColumnLike, *masks: str) -> Column:
    """First mask that parses; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(col(text), F.lit(m)) for m in masks])


def hosp_day(ts: ColumnLike, anchor: ColumnLike, mode: str = "floor", clip: int | None = None, base: int = 0) -> Column:
    """Hospital-day index of ``ts`` counted from ``anchor``.

    ``mode``: ``floor``, ``ceil`` or ``trunc`` of the elapsed days, or
    ``calendar`` for the difference of dates.  ``clip`` is the lowest day kept
    as is, earlier days become ``clip``; ``base`` is added last.
    """
    if mode == "calendar":
        day = F.datediff(col(ts), col(anchor)).cast("bigint")
    else:
        days = elapsed(anchor, ts, "days")
        day = {
            "floor": F.floor(days),
            "ceil": F.ceil(days),
            "trunc": F.when(days < 0, F.ceil(days)).otherwise(F.floor(days)),
        }[mode].cast("bigint")
    if clip is not None:
        day = F.when(day < clip, F.lit(clip).cast("bigint")).otherwise(day)
    return day + F.lit(base).cast("bigint")


def shift_day(ts: ColumnLike, start_hour: float = 7) -> Column:
    """Day of a shift that starts at ``start_hour``."""
    return F.date_trunc("day", offset(ts, -start_hour))


def fiscal_year(ts: ColumnLike, lead_months: int = 6) -> Column:
    """First day of the (calendar-labelled) year that a fiscal year is named after."""
    return F.date_trunc("year", F.add_months(F.date_trunc("month", col(ts)), lead_months))


def age_years(birth: ColumnLike, at: ColumnLike) -> Column:
    """Whole years by the 365.25-day rule."""
    return F.floor(F.datediff(col(at), col(birth)) / F.lit(365.25)).cast("bigint")


# ------------------------------------------------------------ missing values

def if_missing_aware(condition: Column, yes, no, missing=None) -> Column:
    """Three-way if: ``missing`` where the condition is NULL."""
    return F.when(condition.isNull(), missing).when(condition, yes).otherwise(no)


def least_known(*cols: ColumnLike) -> Column:
    """Row-wise minimum that skips NULLs."""
    return F.least(*[col(c) for c in cols])


def least_strict(*cols: ColumnLike) -> Column:
    """Row-wise minimum that is NULL when any argument is (the warehouse rule)."""
    known = F.lit(True)
    for c in cols:
        known = known & col(c).isNotNull()
    return F.when(known, F.least(*[col(c) for c in cols]))


def null_if(c: ColumnLike, sentinel) -> Column:
    return F.nullif(col(c), F.lit(sentinel))


def decode(c: ColumnLike, mapping: Mapping, default=None) -> Column:
    """Equality chain in which NULL matches a NULL key."""
    out = None
    for key, value in mapping.items():
        hit = col(c).eqNullSafe(F.lit(key))
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(F.lit(default))


# ----------------------------------------------------------------------- text

def classify(c: ColumnLike, patterns: Mapping[str, str], default: str | None = None) -> Column:
    """Label of the first regular expression that matches (order matters)."""
    out = None
    for label, pattern in patterns.items():
        hit = col(c).rlike(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def replace_each(c: ColumnLike, replacements: Mapping[str, str]) -> Column:
    """Apply regular-expression replacements one after another."""
    out = col(c)
    for pattern, by in replacements.items():
        out = F.regexp_replace(out, pattern, by)
    return out


def remove_words(c: ColumnLike, words: Sequence[str]) -> Column:
    return F.trim(F.regexp_replace(col(c), "|".join(words), ""))


def clean_name(name: str) -> str:
    """Column name in lower case, words joined by underscores."""
    return re.sub(r"\W+", "_", name.strip().lower()).strip("_")


def parse_result(text: ColumnLike) -> Column:
    """Struct ``(value, censor_low, censor_high)`` of a result text.

    ``"<3"`` is 3 censored low, ``">600"`` 600 censored high, thousands commas
    are dropped, and anything that is still not a number gives a NULL value.
    """
    t = col(text)
    digits = F.trim(F.regexp_replace(t, "[<>,]", ""))
    number = F.when(digits.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"), digits).try_cast("double")
    return F.struct(
        number.alias("value"), t.contains("<").alias("censor_low"), t.contains(">").alias("censor_high")
    )


def is_numeric_text(text: ColumnLike) -> Column:
    return ~col(text).rlike("[A-Za-z]")


def repair_account_id(c: ColumnLike, head: int = 8, width: int = 12) -> Column:
    """Account ids shorter than ``width`` lost the leading zeros of the part after
    the first ``head`` characters: pad that part and rejoin."""
    tail = F.lpad(F.substring(col(c), head + 1, width), width - head, "0")
    return F.when(F.length(col(c)) < width, F.concat(F.substring(col(c), 1, head), tail)).otherwise(col(c))


# ------------------------------------------------------------ many columns

def across(cols: Sequence[str], fn: Callable[[Column], Column], names: str = "{col}") -> dict[str, Column]:
    """The same expression on many columns, for ``withColumns``."""
    return {names.format(col=c): fn(F.col(c)) for c in cols}


def across_aggs(cols: Sequence[str], fns: Mapping[str, Callable[[Column], Column]], names: str = "{col}_{fn}") -> list[Column]:
    """Several aggregates on many columns, named by a template."""
    return [fn(F.col(c)).alias(names.format(col=c, fn=n)) for c in cols for n, fn in fns.items()]


def columns_like(df: DataFrame, starts=None, ends=None, contains=None, matches=None) -> list[str]:
    """Names that meet every given pattern."""
    return [
        c
        for c in df.columns
        if (starts is None or c.startswith(starts))
        and (ends is None or c.endswith(ends))
        and (contains is None or contains in c)
        and (matches is None or re.search(matches, c))
    ]


def rename_all(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def fill_flags(df: DataFrame, cols: Sequence[str] | None = None, value: bool = False) -> DataFrame:
    """Absent flags become ``value``; by default in every boolean column."""
    names = cols or [f.name for f in df.schema if f.dataType.typeName() == "boolean"]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in names})


# ------------------------------------------------------------------ medicines

# Route group -> pattern of the charted route.
ROUTE_GROUPS = {
    "iv": "IV",
    "po": "^(PO|GT|NJ|NG|DHT|OGT|T FEED|PEG)$",
    "subq": "SUB-?Q|SUBCUT",
}

# Factor that turns a rate into microgram/kg/min, and whether the
# rate is still to be divided by the weight.
RATE_UNITS = [
    ("microgram/kg/min", 1.0, False),
    ("mcg/kg/min", 1.0, False),
    ("microgram/kg/hr", 1.0 / 60, False),
    ("mg/kg/hr", 1000.0 / 60, False),
    ("mg/kg/min", 1000.0, False),
    ("mg/hr", 1000.0 / 60, True),
    ("microgram/min", 1.0, True),
    ("mg/min", 1000.0, True),
]

# Phrases of a free-text rate that hold no rate, the number in it, and the spellings of its units.
RATE_PHRASES = ["titrate", "see comments", "as directed", "continue at", "for 6-hours.", "over 24 hours", "run at", "infusion rate -"]
RATE_NUMBER = r"[0-9]\.?[0-9]{0,2}"
RATE_SPELLINGS = r"microgram[s]?/kg/min|mcg/kg/min|ml/h[r]?|cc/hr|ml per hour|ml/hour"
RATE_NAMES = {
    "ml/h": "ml/hr", "cc/hr": "ml/hr", "ml per hour": "ml/hr", "ml/hour": "ml/hr",
    "micrograms/kg/min": "microgram/kg/min", "mcg/kg/min": "microgram/kg/min",
}
# Fixed value: concentration of an infusion that has none on record.
DEFAULT_CONCENTRATION = 75.0

# Microgram per unit of a bolus dose; doses in other units (mL) are not boluses.
DOSE_UNITS = {"mg": 1000.0, "microgram": 1.0}

# Salt and vehicle words that are not part of an ingredient name.
SALT_WORDS = ["dextrose", " in", "sodium chloride", "water for injection sterile", "nacl", "hcl", "d5w"]


def route_group(route: ColumnLike, groups: Mapping[str, str] = ROUTE_GROUPS) -> Column:
    """iv / po / subq / other; an unknown route is other."""
    return classify(route, groups, "other")


def canonical_med(name: ColumnLike, ingredients: Mapping[str, str] | None = None, words=SALT_WORDS) -> Column:
    """Ingredient name: lower case, salts removed, then the first matching pattern."""
    plain = remove_words(F.lower(col(name)), words)
    return F.coalesce(classify(plain, ingredients), plain) if ingredients else plain


def normalize_rate(rate, unit, weight, dose=None, dose_unit=None, concentration=None, volume=None) -> Column:
    """Rate in microgram/kg/min; first rule that applies wins.

    A charted unit converts the rate (a missing rate stays missing).  Without a
    known unit a missing rate is derived from the hourly dose: mg as given, mL
    through ``concentration / volume``.  Other rates stay as charted.
    """
    out = None
    for name, factor, per_weight in RATE_UNITS:
        value = col(rate) * F.lit(factor)
        value = value / col(weight) if per_weight else value
        out = (F if out is None else out).when(col(unit) == name, value)
    if dose is not None:
        unknown = col(rate).isNull()
        per_min = F.lit(1000.0 / 60) / col(weight)
        if concentration is not None:
            mg = col(dose) * col(concentration) / F.nullif(col(volume), F.lit(0.0))
            out = out.when(unknown & (col(dose_unit) == "mL") & col(concentration).isNotNull(), mg * per_min)
        out = out.when(unknown & (col(dose_unit) == "mg"), col(dose) * per_min)
    return out.otherwise(col(rate))


def free_text_rate(text: ColumnLike) -> Column:
    """``rate`` and ``unit`` of a rate typed as text, null where there is none.

    Phrases that hold no rate are removed, the first number and the first known
    unit are taken, and the unit gets one name whatever its spelling.
    """
    plain = F.regexp_replace(F.lower(col(text)), "|".join(RATE_PHRASES), "")
    number = F.regexp_extract(plain, RATE_NUMBER, 0)
    unit = F.nullif(F.regexp_extract(plain, RATE_SPELLINGS, 0), F.lit(""))
    names = F.create_map(*[F.lit(x) for pair in RATE_NAMES.items() for x in pair])
    return F.struct(number.try_cast("double").alias("rate"), F.coalesce(F.try_element_at(names, unit), unit).alias("unit"))


def free_text_to_weight_rate(text: ColumnLike, weight, concentration=None, volume=None, default: float = DEFAULT_CONCENTRATION) -> Column:
    """A free-text rate in microgram/kg/min: mL per hour through ``concentration / volume`` (mg per mL); other units are unknown."""
    read = free_text_rate(text)
    strength = F.coalesce(col(concentration).try_cast("double"), F.lit(default)) if concentration is not None else F.lit(default)
    per_ml = strength / F.nullif(col(volume).try_cast("double"), F.lit(0.0)) if volume is not None else strength
    by_volume = read["rate"] * per_ml * F.lit(1000.0 / 60) / F.nullif(col(weight), F.lit(0.0))
    return F.when(read["unit"] == "ml/hr", by_volume).when(read["unit"] == "microgram/kg/min", read["rate"])


def dose_per_weight(dose: ColumnLike, unit: ColumnLike, weight: ColumnLike, units: Mapping[str, float] = DOSE_UNITS) -> Column:
    """A dose in microgram/kg; null in units that are not listed."""
    out = None
    for name, factor in units.items():
        out = (F if out is None else out).when(col(unit) == name, col(dose) * F.lit(factor) / F.nullif(col(weight), F.lit(0.0)))
    return out
