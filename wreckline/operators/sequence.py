"""Sequence numbers of units within their crash (``row_number`` by CRASH_UNIT_ID)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wreckline.operators.skew import DEFAULT_HOT_ROWS, HotKeys, route_hot

CRASH_KEY = "CRASH_RECORD_ID"
SEQ_COL = "veh_seq_nbr"

# The one order of units within a crash, used by numbering, slots and summaries alike:
# CRASH_UNIT_ID, then these, so that every operator agrees on which unit is the k-th (the
# studied pipeline leaves ties to chance). Units that agree on all are interchangeable.
UNIT_TIE_BREAKERS = [
    "VEHICLE_ID", "CRASH_DATE", "RD_NO", "UNIT_NO", "UNIT_TYPE", "NUM_PASSENGERS",
    "CMRC_VEH_I", "MAKE", "MODEL",
]

# Rows in the sample that cuts huge crashes into blocks, about, and blocks of a crash, at most.
SAMPLE = 20_000
_SPLITS = 128
# Copies of a row that one row stands for until the last step, at most.
_COPIES_PER_ROW = 65_536


def unit_order(df: DataFrame, tie_breakers: list[str] | None = None) -> list[Column]:
    """CRASH_UNIT_ID ascending (NULLs first, Spark's default), then the tie breakers."""
    ties = UNIT_TIE_BREAKERS if tie_breakers is None else tie_breakers
    cols = ["CRASH_UNIT_ID"] + [c for c in ties if c in df.columns]
    return [F.col(c).asc_nulls_first() for c in cols]


def number_units(
    vehicles: DataFrame,
    out: str = SEQ_COL,
    tie_breakers: list[str] | None = None,
    skew_safe: bool | str = "auto",
    hot_rows: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``out`` = 1, 2, ... per crash in unit order.

    ``skew_safe=False`` is one hash exchange on the crash key plus a sort: the plan the
    studied job has, and the cheapest when no crash is huge. ``skew_safe=True`` numbers
    a huge crash in many tasks (see ``number_by_bounds``). ``"auto"`` does the latter
    for crashes with >= ``hot_rows`` units and for units without a crash id.
    """
    if skew_safe == "auto":
        return route_hot(
            vehicles, CRASH_KEY,
            lambda df: number_units(df, out, tie_breakers, skew_safe=False),
            lambda df: number_units(df, out, tie_breakers, skew_safe=True),
            hot_rows or DEFAULT_HOT_ROWS, hot,
        )
    if skew_safe:
        return number_by_bounds(vehicles, out, tie_breakers)
    w = Window.partitionBy(CRASH_KEY).orderBy(*unit_order(vehicles, tie_breakers))
    return vehicles.withColumn(out, F.row_number().over(w))


def number_by_bounds(vehicles: DataFrame, out: str = SEQ_COL, tie_breakers: list[str] | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by crash order by unit order)`` for huge crashes.

    1. Equal rows are counted (combined before the shuffle), stand as one row and are written.
    2. Of these, a sample by hash of the row (about ``SAMPLE`` in all, so only crashes with many
       rows have some) gives each such crash up to ``_SPLITS`` bounds in the whole unit order.
       A row's block is the number of bounds that are not above it: a function of the written
       rows alone, however often a stage is recomputed, and units that tie on CRASH_UNIT_ID, or
       have none, still fall into different blocks.
    3. Rows before a block: a running sum over the blocks of the crash, a small table.
    4. Within a block, a running sum over its rows in unit order; then copies are expanded into
       consecutive numbers.
    """
    from wreckline.sources.sinks import stage_parquet  # sources import the operators

    columns = vehicles.columns
    ordering = ["CRASH_UNIT_ID"] + [c for c in (UNIT_TIE_BREAKERS if tie_breakers is None else tie_breakers) if c in columns]
    ordering += [c for c in columns if c not in ordering and c != CRASH_KEY]  # a short tie list stays deterministic
    rows = stage_parquet(vehicles.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), name="units")
    me = F.struct(*[F.col(c) for c in ordering])

    every = max(1, rows.count() // SAMPLE)
    sample = rows.where(F.pmod(F.xxhash64(*columns), F.lit(every)) == 0)
    sorted_sample = F.sort_array(F.collect_list(me))
    taken = sample.groupBy(F.col(CRASH_KEY).alias("_crash")).agg(sorted_sample.alias("_s")).where(F.size("_s") > 1)
    step = F.greatest(F.lit(1), F.floor(F.size("_s") / _SPLITS)).cast("int")
    # At most about SAMPLE bounds in all. Written, so that their size is known when the join is
    # planned: where they are small, the rows are not shuffled for it.
    bounds = stage_parquet(taken.select("_crash", F.filter("_s", lambda _, i: i % step == 0).alias("_bounds")), name="bounds")
    placed = rows.join(bounds, F.col(CRASH_KEY).eqNullSafe(F.col("_crash")), "left").withColumn(
        "_block", F.when(F.col("_bounds").isNull(), -1).otherwise(F.size(F.filter("_bounds", lambda b: b <= me)))).drop("_bounds", "_crash")

    offsets = placed.where("_block >= 0").groupBy(CRASH_KEY, "_block").agg(F.sum("_n").alias("_n"))
    offsets = stage_parquet(offsets.select(
        F.col(CRASH_KEY).alias("_crash"), F.col("_block").alias("_of"),
        _running(F.col("_n"), [CRASH_KEY], "_block").alias("_before")), name="offsets")
    block = Window.partitionBy(CRASH_KEY, "_block").orderBy(*[F.col(c).asc_nulls_first() for c in ordering])
    inside = F.coalesce(F.sum("_n").over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("_inside", inside).join(
        offsets, F.col(CRASH_KEY).eqNullSafe(F.col("_crash")) & (F.col("_block") == F.col("_of")), "left")
    start = F.coalesce("_before", F.lit(0)) + F.col("_inside")
    chunks = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _COPIES_PER_ROW))
    numbered = numbered.select(*columns, "_n", start.alias("_start"), F.explode(chunks).alias("_chunk"))
    first = F.col("_chunk") * _COPIES_PER_ROW
    copies = F.sequence(first + 1, F.least(F.col("_n"), first + _COPIES_PER_ROW))
    return numbered.select(*columns, "_start", F.explode(copies).alias("_copy")).select(
        *columns, (F.col("_start") + F.col("_copy")).cast("int").alias(out))


def _running(value: Column, keys: list[str], by: str) -> Column:
    before = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))
