"""Filters as boolean columns, and ranges as literals that reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import age_years, col, offset

# Fixed value: rows valid after this date are the current version.
OPEN_END = "2099-12-31"
PRESETS = ("Today", "Yesterday", "Week to Date", "Last Week", "Last Month", "Month to Date", "User-defined", "N Days Prior")
UTC = dt.timezone.utc


def current_version(valid_until=None, active=None, end_effective=None, as_of: dt.datetime | None = None) -> Column:
    """Row is the current version by whichever of the three marks the table has."""
    out = F.lit(True)
    if valid_until is not None:
        out = out & (col(valid_until) > F.lit(OPEN_END).cast("timestamp"))
    if active is not None:
        out = out & (col(active) == 1)
    if end_effective is not None:
        out = out & (col(end_effective) > F.lit(as_of or dt.datetime.now(UTC)))
    return out


def date_range(preset: str, as_of: dt.datetime, zone: str = "UTC", week_start: int = 6,
               lo: dt.datetime | None = None, hi: dt.datetime | None = None, days: float = 0):
    """First and last UTC instant of a relative-date preset, ends included.

    Days start at midnight in ``zone``; ``week_start`` counts from Monday = 0
    (6 = Sunday).  ``as_of`` is the instant to count from, so a run can be
    repeated.  The result is two literals, which the scan can use directly.
    """
    tz = ZoneInfo(zone)
    now = as_of if as_of.tzinfo else as_of.replace(tzinfo=UTC)
    wall = now.astimezone(tz).replace(tzinfo=None)
    day = wall.replace(hour=0, minute=0, second=0, microsecond=0)
    week = day - dt.timedelta(days=(day.weekday() - week_start) % 7)
    month = day.replace(day=1)
    second = dt.timedelta(seconds=1)
    one = dt.timedelta(days=1)
    local = {
        "Today": (day, day + one - second),
        "Yesterday": (day - one, day - second),
        "Week to Date": (week, day - second),
        "Last Week": (week - 7 * one, week - second),
        "Last Month": ((month - one).replace(day=1), month - second),
        "Month to Date": ((day - one).replace(day=1), day - second),
        "User-defined": (lo, hi),
        "N Days Prior": (wall - dt.timedelta(days=days), wall),
    }[preset]
    return tuple(None if t is None else t.replace(tzinfo=tz).astimezone(UTC) for t in local)


def in_range(ts, bounds) -> Column:
    lo, hi = bounds
    return col(ts).between(F.lit(lo), F.lit(hi))


def adult(birth, at, years: int = 18) -> Column:
    return age_years(birth, at) >= years


def around(ts, anchor, before: float, after: float, unit: str = "hours") -> Column:
    """``ts`` in [anchor - before, anchor + after]."""
    return col(ts).between(offset(anchor, -before, unit), offset(anchor, after, unit))


def plausible(value, low: float, high: float) -> Column:
    """Strictly inside the plausible band; unknown values are not."""
    return F.coalesce((col(value) > low) & (col(value) < high), F.lit(False))


def any_of(*rules: dict) -> Column:
    """OR of ANDs; a rule maps a column to a value, a list, or a function of the column."""
    out = F.lit(False)
    for rule in rules:
        hit = F.lit(True)
        for name, want in rule.items():
            c = F.col(name)
            hit = hit & (want(c) if callable(want) else c.isin(list(want)) if isinstance(want, (list, tuple, set)) else c == want)
        out = out | hit
    return out


def in_codes(df: DataFrame, column: str, codes: Sequence, keep: bool = True) -> DataFrame:
    """Keep (or drop) rows whose code is in a literal list.

    Short lists become an IN that the scan can use; long lists a join against
    the list, which is a driver-side literal and so always small.
    """
    codes = list(dict.fromkeys(codes))
    if len(codes) <= 50:
        return df.filter(F.col(column).isin(codes) if keep else ~F.coalesce(F.col(column).isin(codes), F.lit(False)))
    kind = df.schema[column].dataType.simpleString()
    listed = df.sparkSession.createDataFrame([(c,) for c in codes], f"{column} {kind}")
    return df.join(F.broadcast(listed), column, "left_semi" if keep else "left_anti")
