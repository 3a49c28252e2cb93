"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# A word is a maximal run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver does, for sessions
    started without it on PYTHONPATH; a cluster job ships it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return  # another environment would start a second set of workers
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the cluster's shared folder and read it back: cuts the
    lineage with files that every executor sees and that outlive a lost executor."""
    path = shared_dir(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps. Spark removes them when the driver's JVM
    collects the frames that made them, which a driver with little garbage seldom does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, bound as a lambda variable: an
    expression repeated inside a higher-order function would run once per element."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """All words of a text as an array; a null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def apart(df: DataFrame, names: frozenset[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``operator`` makes of ``df``, with the columns of ``df`` and their own values: a
    column named as one that the operator adds or uses is set aside under another name."""
    aside = {c: f"{c} (given)" for c in df.columns if c.lower() in names or c.startswith("__")}
    given = df.select(*[F.col(f"`{c}`").alias(aside.get(c, c)) for c in df.columns])
    return operator(given).select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in df.columns])


def with_column_replaced(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns; an input column of the same name (in any case) is replaced."""
    new = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in new]
    return df.select(*kept, *[c.alias(name) for name, c in columns.items()])
