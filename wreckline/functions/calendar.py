"""Calendar attributes of a crash timestamp (month, year, year-month label, weekday, hour).

All builders work on both ``timestamp_ntz`` and ``timestamp`` inputs. For wall-clock
(``timestamp_ntz``) input the truncations go through ``date`` so they never depend on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weekday labels in the order the studied pipeline's CASE lists them,
# which is the order of its intended day numbers 0..6 (Sunday first).
WEEKDAY_LABELS = ["SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY"]


def _is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def truncate(ts: Column, unit: str, wall_clock: bool) -> Column:
    """``date_trunc(unit, ts)``; for wall-clock input the result stays wall-clock."""
    if wall_clock:
        return F.trunc(ts.cast("date"), unit).cast("timestamp_ntz")
    return F.date_trunc(unit, ts)


def weekday_label(ts: Column, compat: bool) -> Column:
    """Upper-case weekday name.

    compat: the studied CASE maps day numbers 0..6 with Sunday = 0, but Spark numbers
    days 1..7 with Sunday = 1. Every label therefore lands one day late and Saturday
    (7) falls through to NULL.
    """
    dow = F.dayofweek(ts)  # Sunday = 1 ... Saturday = 7
    labels = F.array(*[F.lit(x) for x in WEEKDAY_LABELS])
    if compat:
        return F.when(dow <= 6, F.get(labels, dow))
    return F.get(labels, dow - 1)


def year_month_label(year_start: Column, month_start: Column, ts: Column, compat: bool) -> Column:
    """compat: two full timestamps joined by '_' (NULL when the date is NULL); else 'yyyy_MM'."""
    if compat:
        return F.concat(year_start.cast("string"), F.lit("_"), month_start.cast("string"))
    return F.date_format(ts, "yyyy_MM")


def with_calendar(df: DataFrame, date_col: str = "CRASH_DATE", compat: bool = True) -> DataFrame:
    """Add CRASH_MONTH, CRASH_YEAR, YEAR_MONTH, DAY_OF_WEEK, HOUR_OF_DAY (narrow, no shuffle)."""
    ts = F.col(date_col)
    ntz = _is_ntz(df, date_col)
    month = truncate(ts, "month", ntz)
    year = truncate(ts, "year", ntz)
    return df.select(
        "*",
        month.alias("CRASH_MONTH"),
        year.alias("CRASH_YEAR"),
        year_month_label(year, month, ts, compat).alias("YEAR_MONTH"),
        weekday_label(ts, compat).alias("DAY_OF_WEEK"),
        F.hour(ts).alias("HOUR_OF_DAY"),
    )
