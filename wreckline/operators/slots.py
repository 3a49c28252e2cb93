"""The first units of each crash as fixed slots (VEHICLE1..4), without self-joins.

The studied job numbers units per crash and left-joins the unit table to itself four
times, once per slot k, on (CRASH_RECORD_ID, CRASH_DATE, CRASH_UNIT_ID, VEHICLE_ID)
against the unit with sequence k. Because the sequence is unique per crash, a unit row
receives slot k's values exactly when its own four keys equal those of the k-th unit
(all four non-NULL). So slot values are a property of a unit's key tuple, and only
units whose CRASH_UNIT_ID ranks within the first k of their crash can match at all.

``slot_candidates`` takes the first k distinct units in the whole unit order. Catalyst
turns that ``row_number() <= k`` into a window-group limit that runs *before* the shuffle
as well: each map task forwards at most k rows per crash, whatever ties there are, and one
more limit takes the first k of those. A crash holding a third of all rows costs no more
shuffle than any other. Units that merely share a holder's keys are counted by their keys
(``slot_rows``) and never gathered row by row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wreckline.functions.text import fallback
from wreckline.operators.sequence import CRASH_KEY, SEQ_COL, UNIT_TIE_BREAKERS, number_units, unit_order
from wreckline.operators.skew import DEFAULT_HOT_ROWS, HotKeys, route_hot
from wreckline.schemas import SLOT_COUNT, vehicle_slot_columns

UNIT_KEYS = ["CRASH_RECORD_ID", "CRASH_DATE", "CRASH_UNIT_ID", "VEHICLE_ID"]
# Everything the slot logic reads or orders by.
SLOT_INPUT = list(dict.fromkeys(UNIT_KEYS + UNIT_TIE_BREAKERS))
# How many equal rows a candidate row stands for.
COPIES = "_copies"


def slot_candidates(vehicles: DataFrame, n: int = SLOT_COUNT) -> DataFrame:
    """The first n distinct units of each crash in the unit order, with the number of copies
    of each and the sequence number of its first copy: every slot holder is among them.

    Copies are counted before the limit, where the aggregation combines them in each map
    task. The order covers all columns that are read, so no rows tie: units that are equal
    in CRASH_UNIT_ID, or all lack it, are cut to n in each map task like any others. The counted
    units, whole rows, are written, so that their shuffle does not stay beside the next one.
    """
    from wreckline.sources.sinks import stage_parquet  # sources import the operators

    in_order = Window.partitionBy(CRASH_KEY).orderBy(*unit_order(vehicles))
    rows = vehicles.groupBy(*[c for c in SLOT_INPUT if c in vehicles.columns]).agg(F.count(F.lit(1)).alias(COPIES))
    rows = stage_parquet(rows, name="units")
    first = rows.withColumn("_place", F.row_number().over(in_order)).filter(F.col("_place") <= n).drop("_place")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    return first.withColumn(SEQ_COL, F.sum(COPIES).over(upto) - F.col(COPIES) + 1)


def slot_rows(vehicles: DataFrame, n: int = SLOT_COUNT) -> DataFrame:
    """Units whose four keys hold a slot in the compat sense, as one row per (keys, RD_NO)
    with the number of units (COPIES) and the slot columns.

    Units are counted by their keys first, in the map tasks; of the counted keys a crash
    keeps those that rank <= n in the unit order, whose leading columns the keys are. A
    holder has at most n - 1 rows before it, so its keys are among them. Rows that rank
    equal differ in RD_NO alone, and each of those is a group of the result.
    """
    units = reduce(DataFrame.filter, [F.col(k).isNotNull() for k in UNIT_KEYS], vehicles)
    units = units.groupBy(*UNIT_KEYS, "RD_NO").agg(F.count(F.lit(1)).alias(COPIES))
    by_keys = Window.partitionBy(CRASH_KEY).orderBy("CRASH_UNIT_ID", "VEHICLE_ID", "CRASH_DATE")
    units = units.withColumn("_rank", F.rank().over(by_keys)).filter(F.col("_rank") <= n).drop("_rank")
    both = units.unionByName(slot_candidates(vehicles, n), allowMissingColumns=True)
    matched = matched_slots(both, n).filter(F.col(SEQ_COL).isNull() & any_slot(n))
    return matched.select(*units.columns, *vehicle_slot_columns(n))


def _holds(k: int) -> Column:
    """Whether one of the row's copies is the k-th unit."""
    return (F.col(SEQ_COL) <= k) & (F.col(SEQ_COL) + F.col(COPIES) > k)


def _holder() -> Column:
    """What a unit contributes when it holds a slot."""
    return F.struct(
        F.col("CRASH_DATE").alias("d"),
        F.col("CRASH_UNIT_ID").alias("u"),
        F.col("VEHICLE_ID").alias("v"),
        fallback(F.col("MAKE"), F.col("UNIT_TYPE")).alias("make"),
        fallback(F.col("MODEL"), F.col("UNIT_TYPE")).alias("model"),
    )


def _slot_values(k: int, holder: Column, hit: Column) -> list[Column]:
    return [
        F.when(hit, holder["u"]).alias(f"VEHICLE{k}_ID"),
        F.when(hit, holder["make"]).alias(f"VEHICLE{k}_MAKE"),
        F.when(hit, holder["model"]).alias(f"VEHICLE{k}_MODEL"),
    ]


def matched_slots(cand: DataFrame, n: int = SLOT_COUNT) -> DataFrame:
    """Candidates with the compat slot columns: slot k filled iff the row's four unit
    keys equal the k-th unit's (NULL never equals), as the self-joins decide."""
    w = Window.partitionBy(CRASH_KEY)
    holders = [F.max(F.when(_holds(k), _holder())).over(w).alias(f"_h{k}") for k in range(1, n + 1)]
    with_h = cand.select("*", *holders)
    cols = []
    for k in range(1, n + 1):
        h = F.col(f"_h{k}")
        hit = (
            F.col(CRASH_KEY).isNotNull()
            & (F.col("CRASH_DATE") == h["d"])
            & (F.col("CRASH_UNIT_ID") == h["u"])
            & (F.col("VEHICLE_ID") == h["v"])
        )
        cols += _slot_values(k, h, hit)
    return with_h.select(*cand.columns, *cols)


def own_slots(cand: DataFrame, n: int = SLOT_COUNT, slot_null_vehicle: bool = False) -> DataFrame:
    """Candidates with the corrected slot columns: the k-th unit fills slot k (units
    without VEHICLE_ID stay out unless ``slot_null_vehicle``)."""
    eligible = F.lit(True) if slot_null_vehicle else F.col("VEHICLE_ID").isNotNull()
    h = _holder()
    cols = []
    for k in range(1, n + 1):
        cols += _slot_values(k, h, _holds(k) & eligible)
    return cand.select(*cand.columns, *cols)


def any_slot(n: int = SLOT_COUNT) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"VEHICLE{k}_ID").isNotNull() for k in range(1, n + 1)])


def null_slots(n: int = SLOT_COUNT) -> list[Column]:
    cols = []
    for k in range(1, n + 1):
        cols += [
            F.lit(None).cast("bigint").alias(f"VEHICLE{k}_ID"),
            F.lit(None).cast("string").alias(f"VEHICLE{k}_MAKE"),
            F.lit(None).cast("string").alias(f"VEHICLE{k}_MODEL"),
        ]
    return cols


def slot_table(vehicles: DataFrame, n: int = SLOT_COUNT) -> DataFrame:
    """One row per unit-key tuple that holds at least one slot, with its slot values."""
    slots = matched_slots(slot_candidates(vehicles, n), n).filter(any_slot(n))
    return slots.groupBy(*UNIT_KEYS).agg(*[F.max(c).alias(c) for c in vehicle_slot_columns(n)])


def vehicle_slots(
    vehicles: DataFrame, n: int = SLOT_COUNT, strategy: str = "auto", hot_rows: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every unit row with its 3 x n slot columns (the studied job's inner SELECT).

    ``topk``: one left join of the units with ``slot_table`` on the four keys. Rows of a
    big crash spread over tasks because CRASH_UNIT_ID is part of the join key.
    ``window``: number all units, then compare each row with the k-th unit of its crash
    in a window over the crash: one shuffle, but a huge crash is one task.
    ``auto``: ``topk`` for crashes with >= ``hot_rows`` units, ``window`` for the rest.
    """
    if strategy == "auto":
        return route_hot(
            vehicles, CRASH_KEY,
            lambda df: vehicle_slots(df, n, "window"),
            lambda df: vehicle_slots(df, n, "topk"),
            hot_rows or DEFAULT_HOT_ROWS, hot,
        )
    if strategy == "window":
        numbered = number_units(vehicles, skew_safe=False).withColumn(COPIES, F.lit(1))
        return matched_slots(numbered, n).select(*vehicles.columns, *vehicle_slot_columns(n))
    if strategy != "topk":
        raise ValueError(f"no such strategy: {strategy}")
    from wreckline.sources.sinks import stage_parquet  # sources import the operators

    # Written, so that its shuffles are gone and its size is known when the join is planned.
    st = stage_parquet(slot_table(vehicles, n), name="slots")
    st = st.select(*[F.col(k).alias(f"_s_{k}") for k in UNIT_KEYS], *vehicle_slot_columns(n))
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in UNIT_KEYS])
    return vehicles.join(st, cond, "left").drop(*[f"_s_{k}" for k in UNIT_KEYS])
