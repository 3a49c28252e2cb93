"""Small operators: filters, look-ups, preview, renames, de-duplication, key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wreckline.operators.sequence import SEQ_COL, number_units
from wreckline.schemas import NUMBERED_VEHICLE_COLUMNS


def filter_drivers(people: DataFrame, driver_type: str = "Driver") -> DataFrame:
    """People whose PERSON_TYPE equals ``driver_type`` (case-sensitive; pushed to the scan)."""
    return people.filter(F.col("PERSON_TYPE") == F.lit(driver_type))


def vehicles_of_crash(vehicles: DataFrame, crash_id: str) -> DataFrame:
    """All units of one crash with their sequence number.

    Numbering is per crash, so filtering first gives the same numbers; the filter goes
    into the Parquet scan and only that crash's rows are read (and numbered across
    range blocks if that one crash is huge).
    """
    one = vehicles.filter(F.col("CRASH_RECORD_ID") == F.lit(crash_id))
    return number_units(one).select(*NUMBERED_VEHICLE_COLUMNS)


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows by ``order_by`` (default: all columns) — a top-k, not a full sort."""
    keys = order_by or df.columns
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def sanitize_columns(df: DataFrame, old: str = " ", new: str = "_") -> DataFrame:
    """Rename every column, replacing ``old`` with ``new`` (one projection, no re-read)."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def dedup_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """GROUP BY every column: one row per distinct row (NULLs are equal here).

    Spark aggregates partially before the shuffle, so heavy duplication is collapsed
    map-side.
    """
    return df.dropDuplicates(subset) if subset else df.distinct()


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def assert_unique_key(df: DataFrame, keys: list[str], sample: int = 5) -> None:
    """Raise if ``keys`` is not unique in ``df``; reports a few offending values."""
    dups = duplicate_keys(df, keys)
    found = dups.limit(sample).collect()
    if found:
        shown = ", ".join(str(tuple(r[k] for k in keys)) + f" x{r['copies']}" for r in found)
        raise ValueError(f"key {keys} is not unique: {shown}")


__all__ = [
    "filter_drivers", "vehicles_of_crash", "preview", "sanitize_columns", "dedup_rows",
    "duplicate_keys", "assert_unique_key", "SEQ_COL",
]
