"""End-to-end transforms: crash summary (A), crash + units (A'), unit-person detail (B)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wreckline.functions.calendar import with_calendar
from wreckline.functions.text import clean_category, street_label
from wreckline.operators.basic import dedup_rows, filter_drivers
from wreckline.operators.skew import DEFAULT_HOT_ROWS, HotKeys, count_hot, split_hot
from wreckline.operators.summaries import people_summary, vehicle_summary
from wreckline.schemas import (
    CRASH_COLUMNS,
    CRASH_SUMMARY_COLUMNS,
    CRASH_VEHICLE_SUMMARY_COLUMNS,
    VEHICLE_PERSON_DETAIL_COLUMNS,
    person_slot_columns,
    vehicle_slot_columns,
)
from wreckline.sources.sinks import stage_parquet

_KEY = "CRASH_RECORD_ID"
_JOIN_KEYS_COMPAT = ["CRASH_RECORD_ID", "CRASH_DATE", "RD_NO"]
_JOIN_KEYS_FIXED = ["CRASH_RECORD_ID"]
# What the driver summary reads.
_DRIVER_COLUMNS = ["PERSON_ID", "CRASH_RECORD_ID", "CRASH_DATE", "RD_NO", "PERSON_TYPE", "SEX", "AGE", "INJURY_CLASSIFICATION"]
# What the unit-person detail reads of each table.
_DETAIL_INPUT = [
    ["CRASH_RECORD_ID", "CRASH_DATE", "WEATHER_CONDITION", "LIGHTING_CONDITION", "PRIM_CONTRIBUTORY_CAUSE",
     "STREET_NO", "STREET_DIRECTION", "STREET_NAME", "INJURIES_TOTAL", "INJURIES_FATAL"],
    ["CRASH_RECORD_ID", "CRASH_DATE", "CRASH_UNIT_ID", "VEHICLE_ID", "MAKE", "MODEL", "UNIT_TYPE"],
    ["CRASH_RECORD_ID", "CRASH_DATE", "VEHICLE_ID", "PERSON_ID", "PERSON_TYPE", "SEX", "AGE"],
]


def crash_calendar(crashes: DataFrame, compat: bool = True) -> DataFrame:
    """Crash id, date and the five calendar attributes."""
    base = crashes.select("CRASH_RECORD_ID", "CRASH_DATE")
    return with_calendar(base, "CRASH_DATE", compat)


def street_labels(crashes: DataFrame, compat: bool = True) -> DataFrame:
    """Crash id with '<no> <dir> <name>'."""
    return crashes.select(
        "CRASH_RECORD_ID",
        street_label(F.col("STREET_NO"), F.col("STREET_DIRECTION"), F.col("STREET_NAME"), compat).alias("street"),
    )


def clean_make_model(vehicles: DataFrame, compat: bool = True) -> DataFrame:
    """Units with cleaned make / model next to the raw values."""
    return vehicles.select(
        "CRASH_UNIT_ID", "CRASH_RECORD_ID", "MAKE",
        clean_category(F.col("MAKE"), compat).alias("Vehicle_Make"),
        "MODEL",
        clean_category(F.col("MODEL"), compat).alias("Vehicle_Model"),
    )


def _left_join(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """NULL-never-matches equi left join on ``keys``; right key copies are dropped."""
    renamed = right.select(*[F.col(c).alias(f"{prefix}{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k] == renamed[f"{prefix}{k}"] for k in keys])
    return left.join(renamed, cond, "left").drop(*[f"{prefix}{k}" for k in keys])


def _one_by_one(parts: list[Callable[[], DataFrame]], hot: HotKeys) -> DataFrame:
    """The rows of all parts. Where many ids are hot both parts are large: all but the last are
    written, so that the shuffles of one are gone before those of the next are made."""
    made = [make() if not hot.shuffled or make is parts[-1] else stage_parquet(make(), name="part") for make in parts]
    return reduce(DataFrame.unionByName, made)


def _crash_side(crashes: DataFrame, keys: list[str], strategy: str) -> DataFrame:
    """Distinct crash rows for the summary joins.

    The studied jobs GROUP BY every output column after the joins. Each summary row is
    unique on its join keys plus its counts (they are its group keys) and every summary
    column is an output column, so the joined rows are distinct exactly when the crash
    rows are. De-duplicating the 12 crash columns here gives the same rows as the wide
    GROUP BY over 31 / 48 columns, on fewer and narrower rows.

    Ordinary crashes (``window``) are clustered by the join keys first, so the
    de-duplication and both joins share one shuffle. Hot crash ids, e.g. copies of one row
    (``topk``), are de-duplicated before any shuffle instead: each map task sends one copy.
    """
    rows = crashes.select(*CRASH_COLUMNS)
    if strategy == "topk":
        return dedup_rows(rows)
    return dedup_rows(rows.repartition(*keys))


def _summary_joins(
    crashes: DataFrame, vehicles: DataFrame, people: DataFrame | None, compat: bool, strategy: str, hot_rows: int,
    hot: HotKeys | None,
) -> DataFrame:
    """Crashes left-joined with the unit summary and, if given, the driver summary.

    ``auto`` splits all tables by one list of hot crash ids: a crash meets only its own
    summaries, so the parts are independent. Without hot ids the plain plan is all there is.
    """
    keys = _JOIN_KEYS_COMPAT if compat else _JOIN_KEYS_FIXED
    if strategy == "auto":
        # Only what the summaries read: the split may write it.
        drivers = [] if people is None else [filter_drivers(people).select(*_DRIVER_COLUMNS)]
        tables = [crashes.select(*CRASH_COLUMNS), vehicles, *drivers]
        if hot is None:
            hot = count_hot(tables, _KEY, hot_rows)
        parts = zip(*[split_hot(df, _KEY, hot) for df in tables], strict=True) if hot else [tables]
        made = [partial(_summary_joins, *part, *([None] if people is None else []), compat, how, hot_rows, None)
                for part, how in zip(parts, ("window", "topk"), strict=False)]
        return _one_by_one(made, hot)
    out = _crash_side(crashes, keys, strategy)
    parts = [vehicle_summary(vehicles, compat=compat, strategy=strategy)]
    if people is not None:
        parts.append(people_summary(people, compat=compat, strategy={"window": "cluster", "topk": "partial"}[strategy]))
    for i, part in enumerate(parts):
        out = _left_join(out, part if compat else part.drop("RD_NO", "CRASH_DATE"), keys, f"_{i}_")
    out = with_calendar(out, "CRASH_DATE", compat)
    return out.withColumnRenamed("Cnt_Entities_Accid", "CNT_ENTITIES_ACCID").withColumnRenamed(
        "Cnt_MotorVehicles_Accid", "Cnt_MOTORVEHICLES_ACCID")


def crash_vehicle_summary(crashes: DataFrame, vehicles: DataFrame, people: DataFrame | None = None, compat: bool = True,
                          strategy: str = "auto", hot_rows: int = DEFAULT_HOT_ROWS,
                          hot: HotKeys | None = None) -> DataFrame:
    """A': crashes left-joined with the unit summary, calendar attributes, 31 columns.
    ``people`` is not read; jobs pass the same three tables to every transform."""
    out = _summary_joins(crashes, vehicles, None, compat, strategy, hot_rows, hot)
    # Distinct already: the studied job's GROUP BY over every column is done on the
    # crash side (see _crash_side).
    return out.select(*CRASH_VEHICLE_SUMMARY_COLUMNS)


def crash_summary(crashes: DataFrame, vehicles: DataFrame, people: DataFrame, compat: bool = True,
                  strategy: str = "auto", hot_rows: int = DEFAULT_HOT_ROWS, hot: HotKeys | None = None) -> DataFrame:
    """A: crashes left-joined with the unit summary and the driver summary, 48 columns.

    compat joins on (CRASH_RECORD_ID, CRASH_DATE, RD_NO) with NULL never matching, as the
    studied job does; corrected joins one-row-per-crash summaries on CRASH_RECORD_ID.
    ``window`` plans for ordinary crashes, ``topk`` for huge ones, ``auto`` for both: ``hot``
    is the list kept with the zone; without one the ids are counted by a job first.
    """
    out = _summary_joins(crashes, vehicles, people, compat, strategy, hot_rows, hot)
    # Distinct already (the GROUP BY over all 48 columns is done on the crash side).
    return out.select(*CRASH_SUMMARY_COLUMNS)


def vehicle_person_detail(crashes: DataFrame, vehicles: DataFrame, people: DataFrame,
                          compat: bool = True, strategy: str = "auto",
                          hot_rows: int = DEFAULT_HOT_ROWS, hot: HotKeys | None = None) -> DataFrame:
    """B: every unit with its people (left join on crash, date and unit = person's
    VEHICLE_ID), enriched with crash conditions and a street label; 19 distinct columns.

    strategy: ``shuffle`` clusters units, people and crash attributes by (crash, date),
    so all rows of a crash meet in one task. ``spread`` keeps a crash's rows spread by
    unit: each input is de-duplicated on the columns it contributes before its first
    shuffle (copies of a row cost one row per map task), units and people meet on
    (crash, unit, date), and the join of their rows with the crash attributes is left to
    adaptive execution, which broadcasts a side that turns out small and splits skewed
    partitions. ``auto`` sends crashes with >= ``hot_rows`` rows in any of the three
    tables through ``spread`` and the rest through ``shuffle``. Units without a crash id
    or date can match nothing and skip the joins.
    """
    if strategy == "shuffle":
        return _vehicle_person_detail(crashes, vehicles, people, compat, False)
    if strategy == "spread":
        return _vehicle_person_detail(crashes, vehicles, people, compat, True)
    if hot is None:
        hot = count_hot([vehicles, people, crashes], _KEY, hot_rows)
    if not hot:
        return _vehicle_person_detail(crashes, vehicles, people, compat, False)
    tables = [df.select(*read) for df, read in zip((crashes, vehicles, people), _DETAIL_INPUT, strict=True)]
    cold, hot_part = zip(*[split_hot(df, _KEY, hot) for df in tables], strict=True)
    return _one_by_one([partial(_vehicle_person_detail, *cold, compat, False),
                        partial(_vehicle_person_detail, *hot_part, compat, True)], hot)


def _partial_key_copartition(df: DataFrame) -> bool:
    conf = df.sparkSession.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true")
    return conf.strip().lower() == "false"


def _vehicle_person_detail(crashes: DataFrame, vehicles: DataFrame, people: DataFrame, compat: bool,
                           spread: bool) -> DataFrame:
    v = vehicles.select("CRASH_RECORD_ID", "CRASH_DATE", "CRASH_UNIT_ID", "VEHICLE_ID", "MAKE", "MODEL", "UNIT_TYPE")
    p = people.select(
        F.col("CRASH_RECORD_ID").alias("_p_crash"), F.col("CRASH_DATE").alias("_p_date"),
        F.col("VEHICLE_ID").alias("_p_unit"), "PERSON_ID", "PERSON_TYPE", "SEX", "AGE",
    )
    c = crashes.select(
        F.col("CRASH_RECORD_ID").alias("_c_crash"), F.col("CRASH_DATE").alias("_c_date"),
        F.col("WEATHER_CONDITION").alias("weather_condition"),
        F.col("LIGHTING_CONDITION").alias("lighting_condition"),
        F.col("PRIM_CONTRIBUTORY_CAUSE").alias("prim_contributory_cause"),
        street_label(F.col("STREET_NO"), F.col("STREET_DIRECTION"), F.col("STREET_NAME"), compat).alias("street"),
        "INJURIES_TOTAL", "INJURIES_FATAL",
    )
    if spread:
        # Every output column comes from one side and each side's join keys are among its
        # columns, so distinct sides give distinct joined rows: the GROUP BY over all 19
        # columns moves before the joins, where partial aggregation collapses copies
        # before the shuffle and no join multiplies them.
        v, p, c = dedup_rows(v), dedup_rows(p), dedup_rows(c)
        whole = F.col("CRASH_RECORD_ID").isNotNull() & F.col("CRASH_DATE").isNotNull()
        unmatched, v = v.filter(~whole), v.filter(whole)
    elif _partial_key_copartition(crashes):
        # Cluster all three inputs by (crash, date) once: the unit-person join (on
        # crash, unit, date), the crash join and the final de-duplication all reuse it,
        # so the joined unit-person rows are never shuffled again.
        v = v.repartition("CRASH_RECORD_ID", "CRASH_DATE")
        p = p.repartition("_p_crash", "_p_date")
        c = c.repartition("_c_crash", "_c_date")
    vp = v.join(
        p,
        (v.CRASH_RECORD_ID == p._p_crash) & (v.CRASH_UNIT_ID == p._p_unit) & (v.CRASH_DATE == p._p_date),
        "left",
    )
    out = vp.join(c, (vp.CRASH_RECORD_ID == c._c_crash) & (vp.CRASH_DATE == c._c_date), "left")
    if spread:
        out = out.unionByName(unmatched, allowMissingColumns=True)
    out = out.select(
        "CRASH_RECORD_ID", "CRASH_DATE", "CRASH_UNIT_ID", "VEHICLE_ID", "MAKE",
        clean_category(F.col("MAKE"), compat).alias("Vehicle_Make"),
        "MODEL",
        clean_category(F.col("MODEL"), compat).alias("Vehicle_Model"),
        "UNIT_TYPE", "PERSON_ID", "PERSON_TYPE", "SEX", "AGE",
        "weather_condition", "lighting_condition", "prim_contributory_cause", "street",
        "INJURIES_TOTAL", "INJURIES_FATAL",
    )
    if not spread:
        out = dedup_rows(out)
    return out.select(*VEHICLE_PERSON_DETAIL_COLUMNS)


__all__ = [
    "crash_calendar", "street_labels", "clean_make_model", "crash_vehicle_summary", "crash_summary",
    "vehicle_person_detail", "vehicle_slot_columns", "person_slot_columns",
]
