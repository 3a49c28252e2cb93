"""Crash, unit and person tables derived from the TPC-H-shaped test tables.

The studied pipeline reads three open-data extracts that are not shipped. For tests and
benchmarks the same three tables are derived from ``orders`` (one crash per order),
``lineitem`` (one unit per line) and ``part`` (make and model), so every query's work grows
with the given tables. The rules are written once here for Spark and once as SQL in
``wreckline.oracle`` for the independent DuckDB check.

Fixed values: the modulus rules and category literals below are the agreed mapping
(FIXTURES.md section 3); changing any of them changes every expected result.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wreckline.schemas import PEOPLE_COLUMNS_WITH_VEHICLE, VEHICLE_COLUMNS
from wreckline.session import file_system, freed_shuffles

UNIT_LINE_FACTOR = 100000000
UNIT_PART_FACTOR = 1000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _crash_keys() -> list[Column]:
    key = F.col("o_orderkey")
    return [
        key.cast("string").alias("CRASH_RECORD_ID"),
        F.when(key % 13 != 0, F.concat(F.lit("RD"), key.cast("string"))).alias("RD_NO"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))).alias("CRASH_DATE"),
    ]


def crashes_from_orders(orders: DataFrame) -> DataFrame:
    """One crash per order; narrow projection, no shuffle."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return orders.select(
        *_crash_keys(),
        (F.lit(20) + F.lit(5) * (cust % 8)).cast("bigint").alias("POSTED_SPEED_LIMIT"),
        F.when(cust % 4 == 0, "CLEAR").when(cust % 4 == 1, "RAIN").when(cust % 4 == 2, "SNOW")
        .alias("WEATHER_CONDITION"),
        F.when((key % 24).between(7, 18), "DAYLIGHT").otherwise("DARKNESS").alias("LIGHTING_CONDITION"),
        F.col("o_orderpriority").alias("FIRST_CRASH_TYPE"),
        cust.cast("bigint").alias("STREET_NO"),
        F.when(cust % 5 == 0, "N").when(cust % 5 == 1, "S").when(cust % 5 == 2, "E")
        .when(cust % 5 == 3, "W").alias("STREET_DIRECTION"),
        F.concat(F.lit("STREET "), (cust % 50).cast("string")).alias("STREET_NAME"),
        F.when(F.col("o_orderstatus") != "P", key % 4).cast("bigint").alias("INJURIES_TOTAL"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(key % 97 == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("INJURIES_FATAL"),
        F.col("o_orderpriority").alias("PRIM_CONTRIBUTORY_CAUSE"),
    )


def _unit_id() -> Column:
    return (
        F.col("l_linenumber").cast("bigint") * UNIT_LINE_FACTOR
        + F.col("l_partkey") * UNIT_PART_FACTOR
        + F.col("l_suppkey")
    )


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]


def _lines_with_crash(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with the crash columns, clustered by crash.

    The crash id is the order key as text (an injective cast), so the join uses the numeric
    key: cheaper to hash and compare. It is a merge join always: the one shuffle of the lines,
    before the text columns are made of the numbers, also lays the rows of a crash together.
    """
    crash = orders.select("o_orderkey", "o_orderdate").hint("merge")
    joined = lines.join(crash, lines.l_orderkey == crash.o_orderkey, "inner")
    return joined.select(*lines.columns, *_crash_keys())


def vehicles_from_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    parts = part.select("p_partkey", "p_brand", "p_type")
    lines = lineitem.select(*LINE_COLUMNS, "l_quantity")
    # The parts first: should their join shuffle, the rows still end clustered by crash.
    j = _lines_with_crash(lines.join(parts, lines.l_partkey == parts.p_partkey, "inner"), orders)
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    make = (
        F.when(sk % 9 == 0, F.lit(None)).when(sk % 9 == 1, "UNKNOWN").when(sk % 9 == 2, " ")
        .when(sk % 9 == 3, "OTHER (EXPLAIN IN NARRATIVE)").otherwise(F.col("p_brand"))
    )
    model = (
        F.when(sk % 7 == 0, F.lit(None)).when(sk % 7 == 1, "UNKNOWN").when(sk % 7 == 2, " ")
        .when(sk % 7 == 3, "OTHER (EXPLAIN IN NARRATIVE)").otherwise(F.col("p_type"))
    )
    return j.select(
        _unit_id().alias("CRASH_UNIT_ID"),
        "CRASH_RECORD_ID",
        "RD_NO",
        "CRASH_DATE",
        F.col("l_linenumber").cast("string").alias("UNIT_NO"),
        F.when(pk % 5 == 0, "PEDESTRIAN").otherwise("DRIVER").alias("UNIT_TYPE"),
        (F.col("l_quantity").cast("int") % 5).cast("string").alias("NUM_PASSENGERS"),
        F.when(pk % 5 != 0, pk).alias("VEHICLE_ID"),
        F.when(F.col("l_returnflag") == "A", "Y").alias("CMRC_VEH_I"),
        make.alias("MAKE"),
        model.alias("MODEL"),
    ).select(*VEHICLE_COLUMNS)


def people_from_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Drivers (one per line whose unit is not a pedestrian) plus passengers (returned lines).

    One pass over the lines: each line yields an array of zero to two person structs.
    """
    lines = _lines_with_crash(lineitem.select(*LINE_COLUMNS), orders)
    sk, flag = F.col("l_suppkey"), F.col("l_returnflag")
    unit = _unit_id()
    common = {
        "CRASH_RECORD_ID": F.col("CRASH_RECORD_ID"),
        "RD_NO": F.col("RD_NO"),
        "CRASH_DATE": F.col("CRASH_DATE"),
        "SEX": F.when(sk % 3 == 0, "M").when(sk % 3 == 1, "F"),
        "AGE": F.when(sk % 7 != 0, sk % 90 + 5).cast("bigint"),
        "INJURY_CLASSIFICATION": F.when(flag == "N", F.lit(None))
        .when(flag == "A", "NO INDICATION OF INJURY").otherwise("FATAL"),
        "VEHICLE_ID": unit,
    }

    def person(prefix: str, kind: str) -> Column:
        pid = F.concat(F.lit(prefix), F.col("CRASH_RECORD_ID"), F.lit("-"), unit.cast("string"))
        return F.struct(
            pid.alias("PERSON_ID"),
            F.lit(kind).alias("PERSON_TYPE"),
            *[v.alias(k) for k, v in common.items()],
        )

    candidates = F.array(
        F.when(F.col("l_partkey") % 5 != 0, person("O", "Driver")),
        F.when(flag == "R", person("P", "Passenger")),
    )
    people = lines.select(F.explode(F.filter(candidates, lambda p: p.isNotNull())).alias("p"))
    return people.select("p.*").select(*PEOPLE_COLUMNS_WITH_VEHICLE)


def crash_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(crashes, vehicles, people) derived from the test tables under ``sf_dir``."""
    orders = _table(spark, sf_dir, "orders")
    lineitem = _table(spark, sf_dir, "lineitem")
    part = _table(spark, sf_dir, "part")
    return (
        crashes_from_orders(orders),
        vehicles_from_lines(lineitem, orders, part),
        people_from_lines(lineitem, orders),
    )


def land_crash_tables(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the derived tables under ``root`` as a raw Parquet zone, each clustered by crash
    and sorted by crash id: files of even size, so scans of the zone run in as many tasks as it
    has files, and look-ups by crash id skip row groups. Each table is shuffled once, as
    narrow numbers: the orders rebalanced by key, the lines by their join with the orders."""
    from wreckline.sources.hot_list import write_hot_list
    from wreckline.sources.sinks import write_parquet

    _, vehicles, people = crash_tables(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    crashes = crashes_from_orders(orders.hint("rebalance", "o_orderkey"))
    for name, df in (("crash", crashes), ("vehicles", vehicles), ("people", people)):
        write_parquet(df.sortWithinPartitions("CRASH_RECORD_ID"), f"{root}/{name}")
    write_hot_list(spark, root, {name: spark.read.parquet(f"{root}/{name}") for name in ("crash", "vehicles", "people")})
    return root


_LANDED: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    """The session, the folder and the state of its files: changed files land anew."""
    files = []
    for name in ("orders", "lineitem", "part"):
        store, where = file_system(spark, os.path.join(sf_dir, f"{name}.parquet"))
        files += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in store.listStatus(where)]
    return (spark.sparkContext.applicationId, sf_dir, *sorted(files))


def _still_there(root: str) -> bool:
    """Local zones can be cleaned up under a long-lived session; shared ones are kept."""
    local = root[len("file:"):] if root.startswith("file:") else root
    if local.startswith("/"):
        return os.path.exists(os.path.join(local, "people", "_SUCCESS"))
    return True
_LOCK = threading.RLock()


def landed_root(spark: SparkSession, sf_dir: str) -> str:
    """The session's raw zone of ``sf_dir``, landed where it is not there yet."""
    from wreckline.session import shared_dir

    key = _key(spark, sf_dir)
    with _LOCK:
        root = _LANDED.get(key)
        if root is not None and not _still_there(root):
            root = None
        if root is None:
            root = land_crash_tables(spark, sf_dir, shared_dir(spark, "raw"))
            _LANDED[key] = root
    return root


def landed_crash_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The derived tables, landed once per session as a raw Parquet zone and read back.

    This is the studied pipeline's own shape (raw zone first, transforms read it): the
    derivation joins run once, and every query then scans Parquet with pushdown and
    pruning. The zone lives in the shared checkpoint folder (``shared_dir``).
    """
    from wreckline.sources.readers import load_crashes, load_people, load_vehicles

    root = landed_root(spark, sf_dir)
    return load_crashes(spark, f"{root}/crash"), load_vehicles(spark, f"{root}/vehicles"), load_people(
        spark, f"{root}/people"
    )


_CSV: dict[tuple, dict[str, str]] = {}
# Fixed value: the date layout of the open-data CSV exports.
EXPORT_DATE_LAYOUT = "MM/dd/yyyy hh:mm:ss a"
# Rows of a file of a drop, at most.
DROP_FILE_ROWS = 500_000


def exported_csv(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The derived tables written once per session as CSV drops in the export layout
    (header row, US date-time with AM/PM, values kept as they are), for the ingest path. From the
    session's raw zone where it is landed; a run that reads the drops alone needs no such zone.
    Compressed, text as repetitive as this takes a fraction of the disk; a compressed file is
    read by one task, so files are kept small."""
    from wreckline.session import shared_dir

    key = _key(spark, sf_dir)
    with _LOCK:
        paths = _CSV.get(key)
        if paths is not None and not all(_still_csv(p) for p in paths.values()):
            paths = None
        if paths is None:
            root = shared_dir(spark, "drops")
            landed = _LANDED.get(key)
            made = landed_crash_tables if landed is not None and _still_there(landed) else crash_tables
            crashes, vehicles, people = made(spark, sf_dir)
            paths = {}
            for name, df in (("crash", crashes), ("vehicles", vehicles), ("people", people)):
                path = f"{root}/{name}.csv"
                with freed_shuffles(spark):
                    (df.write.mode("overwrite").option("header", True)
                     .option("timestampNTZFormat", EXPORT_DATE_LAYOUT)
                     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                     .option("compression", "gzip").option("maxRecordsPerFile", DROP_FILE_ROWS)
                     .csv(path))
                paths[name] = path
            _CSV[key] = paths
    return paths


def _still_csv(path: str) -> bool:
    local = path[len("file:"):] if path.startswith("file:") else path
    return os.path.exists(os.path.join(local, "_SUCCESS")) if local.startswith("/") else True
