"""Sinks: Parquet zones, stage boundaries, catalog tables (external and managed)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wreckline.session import freed_shuffles, shared_dir

# Property that marks the views which publish_table makes.
PUBLISHED = "wreckline.published"
# Zones, stages and tables take about a third less disk than with Spark's default codec.
CODEC = "zstd"


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    num_files: int | None = None,
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
) -> str:
    """Write Parquet. ``mode``: overwrite | errorifexists | append | ignore. Overwrite
    replaces everything at ``path``, partitions that the new data lacks included, whatever
    the session's partition overwrite mode.

    ``num_files`` is only for small outputs: a ``coalesce`` to n files makes the last
    stage run in n tasks. Left as None, Spark writes one file per (AQE-coalesced) task.

    ``cluster_by`` lays rows of equal keys next to each other: a ``REBALANCE`` by the
    keys (AQE merges small partitions and splits a skewed one, so a key with a third of
    all rows is written by several tasks), then a sort within each file, so row-group
    statistics let filters on the keys skip most of the data.
    """
    out = df
    if cluster_by:
        out = out.hint("rebalance", *cluster_by).sortWithinPartitions(*cluster_by)
    if num_files:
        out = out.coalesce(num_files)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        writer.parquet(path)
    return path


def stage_parquet(
    df: DataFrame, path: str | None = None, name: str = "stage", partition_by: list[str] | None = None
) -> DataFrame:
    """Stage boundary: write, then continue from the written files.

    The default location is a fresh folder under the cluster's shared checkpoint
    directory, so a lost executor never takes staged data with it and the lineage
    behind this point is cut.
    """
    spark = df.sparkSession
    target = path or shared_dir(spark, name)
    write_parquet(df, target, mode="overwrite", partition_by=partition_by)
    # A partitioned write of no rows leaves no file to read the schema from.
    return spark.read.schema(df.schema).parquet(target) if partition_by else spark.read.parquet(target)


def write_table(df: DataFrame, table: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> str:
    """Managed catalog table (fails if it exists unless ``mode`` says otherwise)."""
    writer = df.write.mode(mode).format("parquet").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        writer.saveAsTable(table)
    return table


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _table_type(spark: SparkSession, table: str) -> str | None:
    """MANAGED, EXTERNAL, VIEW, TEMPORARY, or None if there is no such table."""
    return spark.catalog.getTable(table).tableType if spark.catalog.tableExists(table) else None


def register_external(spark: SparkSession, table: str, location: str, replace: bool = True) -> DataFrame:
    """Catalog table over existing Parquet files (schema and partitions read from the files).

    A partitioned folder's partitions are listed in the catalog as they are now; register it
    again when folders were added. ``replace`` drops an earlier external table of that name, whose files stay where they
    are; a managed table or a view of that name is never dropped but refused.
    """
    kind = _table_type(spark, table)
    if kind is not None:
        if not replace or kind != "EXTERNAL":
            raise ValueError(f"{table} exists ({kind.lower()}); only an external table is replaced")
        spark.sql(f"DROP TABLE {_quote(table)}")
    escaped = location.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_quote(table)} USING PARQUET LOCATION '{escaped}'")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"ALTER TABLE {_quote(table)} RECOVER PARTITIONS")
    return spark.table(table)


def _pointer(spark: SparkSession, target: str) -> str | None:
    """The version that a published name points to; None if there is no such name yet."""
    kind = _table_type(spark, target)
    if kind is None:
        return None
    if kind == "VIEW":
        told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(target)}").collect()}
        if told.get(PUBLISHED) == "true":
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(target)}").collect()
            text = next(r.data_type for r in rows if r.col_name == "View Text")
            return re.search(r"`([^`]*__v\d+)`$", text).group(1)
    raise ValueError(f"{target} exists ({kind.lower()}); only a published table is replaced")


def _versions(spark: SparkSession, target: str) -> dict[int, str]:
    """Number -> table name of every version of ``target`` in the catalog, half-written ones too."""
    *database, name = target.split(".")
    within = f" IN {_quote('.'.join(database))}" if database else ""
    rows = spark.sql(f"SHOW TABLES{within} LIKE '{name.lower()}__v*'").collect()  # a few names
    found = {}
    for r in rows:
        number = re.fullmatch(re.escape(name.lower()) + r"__v(\d+)", r.tableName.lower())
        if number and not r.isTemporary:
            found[int(number.group(1))] = ".".join([*database, r.tableName])
    return found


def publish_table(
    spark: SparkSession, source: str | DataFrame, target: str, partition_by: list[str] | None = None
) -> DataFrame:
    """Create-or-replace ``target`` as a copy of ``source`` (a table name or frame).

    Each publish writes a managed table of its own, ``<target>__v<number>``, and ``target`` is
    a view that points to one of them. The view is altered, one catalog operation, when the
    new version is complete: a reader always finds the old or the new rows, whatever columns
    or partitions either has, and a failed write or switch leaves the old version in place.
    The version before the current one is kept for readers that have begun on it; older ones
    and those of failed runs are dropped. One publisher at a time per name: of two that race
    for a number, one fails at its write.

    ``partition_by`` lays the copy out by those columns, so that later filters on them prune,
    through the view as well. A table, or another view, of that name is refused.
    """
    before = _pointer(spark, target)
    known = _versions(spark, target)
    version = f"{target}__v{max(known, default=0) + 1}"
    rows = spark.table(source) if isinstance(source, str) else source
    write_table(rows, version, partition_by=partition_by)
    if before is None:
        spark.sql(f"CREATE VIEW {_quote(target)} TBLPROPERTIES ('{PUBLISHED}' = 'true') AS SELECT * FROM {_quote(version)}")
    else:
        spark.sql(f"ALTER VIEW {_quote(target)} AS SELECT * FROM {_quote(version)}")
    for name in known.values():
        if before is None or name.split(".")[-1].lower() != before.lower():
            spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
    return spark.table(target)


def unpublish_table(spark: SparkSession, target: str) -> None:
    """Drop a published name and all its versions."""
    if _pointer(spark, target) is not None:
        spark.sql(f"DROP VIEW {_quote(target)}")
    for name in _versions(spark, target).values():
        spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
