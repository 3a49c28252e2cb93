"""Readers: Parquet zones with projection, Parquet with a declared schema, typed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wreckline.schemas import (
    CRASH_COLUMNS_WITH_CAUSE,
    PEOPLE_COLUMNS_WITH_VEHICLE,
    VEHICLE_COLUMNS,
)


def load_parquet(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Parquet directory / glob scan; selecting right away fixes the read schema."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def load_crashes(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    return load_parquet(spark, path, columns or CRASH_COLUMNS_WITH_CAUSE)


def load_vehicles(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    return load_parquet(spark, path, columns or VEHICLE_COLUMNS)


def load_people(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    return load_parquet(spark, path, columns or PEOPLE_COLUMNS_WITH_VEHICLE)


def read_with_schema(spark: SparkSession, path: str | list[str], schema: T.StructType | DataFrame) -> DataFrame:
    """Parquet scan with a declared schema (or another frame's schema).

    Parquet resolves columns by name: a declared column that the files do not have reads
    as NULL, and a declared type the files cannot supply fails the scan.
    """
    struct = schema.schema if isinstance(schema, DataFrame) else schema
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(struct).parquet(*paths)


def read_csv_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    mode: str = "FAILFAST",
    corrupt_column: str | None = None,
    timestamp_format: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row.

    With a ``schema`` the scan is split-parallel and typed (no inference pass). Without
    one, types are inferred (an extra pass; use only to bootstrap a schema).
    ``mode``: FAILFAST rejects a ragged or unparsable row, PERMISSIVE keeps it with NULLs
    (and the raw line in ``corrupt_column`` when that column is in the schema).

    Every row is parsed whole, whichever columns are read later, so a ragged row is seen
    (pruned parsing would not notice it); and a file whose header differs from the schema
    fails instead of having its values bound to other columns.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    reader = reader.option("columnPruning", False).option("enforceSchema", False)
    if multiline:
        reader = reader.option("multiLine", True)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.csv(paths)
