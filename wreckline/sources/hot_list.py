"""The hot-key list of a raw zone: counted once when the zone is landed, read as values.

One small table beside the zone's own: (table, key, rows, min_rows) for the crash ids with
``min_rows`` rows or more, at most rows / ``min_rows`` a table, and one row per table with the
number of rows that have no id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wreckline.operators.skew import DEFAULT_HOT_ROWS, HotKeys, key_counts
from wreckline.session import finished, freed_shuffles

FOLDER = "hot_crash_ids"
KEY = "CRASH_RECORD_ID"
# Rows from which an id is listed: a list serves every threshold that is not lower.
LISTED_ROWS = 100_000


def hot_list(tables: dict[str, DataFrame], min_rows: int = LISTED_ROWS) -> DataFrame:
    """The list of a zone's tables, in one partition. Only the listed rows meet there, after a
    shuffle of their own: a ``coalesce`` would count all ids in that one task."""
    out = None
    for name, df in tables.items():
        counts = key_counts(df.select(KEY), KEY, 0).toDF("key", "rows")
        nulls = df.agg(F.count(F.when(F.col(KEY).isNull(), 1)).alias("rows")).select(F.lit(None).cast("string").alias("key"), "rows")
        one = counts.filter((F.col("rows") >= min_rows) & F.col("key").isNotNull()).unionByName(nulls)
        one = one.select(F.lit(name).alias("table"), "key", "rows", F.lit(min_rows).cast("long").alias("min_rows"))
        out = one if out is None else out.unionByName(one)
    return out.repartition(1)


def write_hot_list(spark: SparkSession, root: str, tables: dict[str, DataFrame], min_rows: int = LISTED_ROWS) -> str:
    """Count the crash ids of a landed zone's tables and keep the list under ``root``, as one
    file: it is bounded by the threshold, not by the tables."""
    path = f"{root.rstrip('/')}/{FOLDER}"
    with freed_shuffles(spark):
        hot_list(tables, min_rows).write.mode("overwrite").parquet(path)
    return path


def load_hot_keys(spark: SparkSession, root: str, hot_rows: int = DEFAULT_HOT_ROWS) -> HotKeys | None:
    """Ids with ``hot_rows`` rows or more in any table of the zone; None where the zone has no
    list, or only one of a higher threshold (the operators count for themselves then)."""
    path = f"{root.rstrip('/')}/{FOLDER}"
    if not finished(spark, path):
        return None
    rows = spark.read.parquet(path).collect()
    if not rows or rows[0]["min_rows"] > hot_rows:
        return None
    found = {r["key"] for r in rows if r["rows"] >= hot_rows}
    return HotKeys(tuple(sorted(k for k in found if k is not None)), None in found)
