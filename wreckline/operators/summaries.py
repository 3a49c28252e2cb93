"""Crash-level summaries of units and drivers, without the studied job's self-joins.

Two exact plans per summary, chosen per crash by ``route_hot``:

* window / cluster: one shuffle of the rows by crash, then numbering, slot values and
  both GROUP BYs in place — cheapest while no crash is huge;
* top-k / partial (skew-proof): the few slot-holding rows per crash come from a
  ``rank()``/``row_number() <= n`` filter that Catalyst runs partially before the shuffle,
  every other row is only counted with map-side partial aggregation, and the two are
  combined with ``union`` + ``groupBy`` (counts are sums, slot columns ``max``). No step
  gathers all rows of one crash in one task; no step emits pairs of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wreckline.functions.text import na_text
from wreckline.operators.basic import filter_drivers
from wreckline.operators.sequence import CRASH_KEY, number_units
from wreckline.operators.skew import DEFAULT_HOT_ROWS, HotKeys, route_hot
from wreckline.operators.slots import (
    COPIES,
    null_slots,
    own_slots,
    slot_candidates,
    slot_rows,
    vehicle_slots,
)
from wreckline.schemas import (
    SLOT_COUNT,
    people_summary_columns,
    person_slot_columns,
    vehicle_pivot_columns,
    vehicle_slot_columns,
    vehicle_summary_columns,
)

# The keys the crash summary joins on, in join order (co-partitioning is order-sensitive).
JOIN_KEYS = ["CRASH_RECORD_ID", "CRASH_DATE", "RD_NO"]


def _flag(c: Column) -> Column:
    return c.isNotNull().cast("bigint")


# --------------------------------------------------------------------------- vehicles
def vehicle_summary(
    vehicles: DataFrame,
    compat: bool = True,
    strategy: str = "auto",
    n: int = SLOT_COUNT,
    slot_null_vehicle: bool = False,
    hot_rows: int = DEFAULT_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Units per crash: entity and motor-vehicle counts plus n slot triples.

    compat (as the studied job): counts are taken per (crash, RD_NO, date, slot values)
    and then used as group keys, so a crash yields one row for its slot-holding units
    and one for the others ("overflow" units beyond n, or units whose keys hold NULL),
    unless both rows have the same counts, in which case they merge.
    corrected: one row per crash with true totals and the first n units in the slots.

    strategy: ``window`` (one shuffle by crash, then everything local), ``topk`` (no
    step holds a whole crash: partial top-k + partial counts), ``lookup`` (compat only:
    each unit looks its slots up by its four keys, then both GROUP BYs), ``auto``
    (crashes with >= ``hot_rows`` units go ``topk``, the rest ``window``).
    """
    if strategy == "auto":
        return route_hot(
            vehicles, CRASH_KEY,
            lambda df: _vehicle_summary(df, compat, "window", n, slot_null_vehicle),
            lambda df: _vehicle_summary(df, compat, "topk", n, slot_null_vehicle),
            hot_rows, hot=hot,
        )
    return _vehicle_summary(vehicles, compat, strategy, n, slot_null_vehicle)


def _vehicle_summary(vehicles: DataFrame, compat: bool, strategy: str, n: int, slot_null_vehicle: bool) -> DataFrame:
    if not compat:
        if strategy == "topk":
            return _vehicle_summary_fixed(vehicles, n, slot_null_vehicle)
        return _vehicle_summary_fixed_window(vehicles, n, slot_null_vehicle)
    keys = ["CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", "Cnt_Entities_Accid", "Cnt_MotorVehicles_Accid"]
    if strategy == "topk":
        inner = _vehicle_slot_groups(vehicles, n)
    else:
        per_row = vehicle_slots(vehicles, n, strategy="topk" if strategy == "lookup" else strategy)
        inner = per_row.groupBy("CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", *vehicle_slot_columns(n)).agg(
            F.count("CRASH_UNIT_ID").alias("Cnt_Entities_Accid"),
            F.count("VEHICLE_ID").alias("Cnt_MotorVehicles_Accid"),
        )
        if strategy == "lookup":
            # Written, so that the shuffles of the look-up do not stay while the groups meet again.
            from wreckline.sources.sinks import stage_parquet  # sources import the operators

            inner = stage_parquet(inner, name="slot-groups")
        # A crash has at most n + 1 inner groups per (RD_NO, date), so clustering them by
        # the crash join keys is skew-free; the outer GROUP BY and the later join to the
        # crashes then need no further shuffle. (Those of topk are clustered so already.)
        inner = inner.repartition(*JOIN_KEYS)
    out = inner.groupBy(*keys).agg(*[F.max(c).alias(c) for c in vehicle_slot_columns(n)])
    return out.select(*vehicle_summary_columns(n))


def _vehicle_summary_fixed_window(vehicles: DataFrame, n: int, slot_null_vehicle: bool) -> DataFrame:
    held = own_slots(number_units(vehicles, skew_safe=False).withColumn(COPIES, F.lit(1)), n, slot_null_vehicle)
    out = held.groupBy("CRASH_RECORD_ID").agg(
        F.max("RD_NO").alias("RD_NO"),
        F.max("CRASH_DATE").alias("CRASH_DATE"),
        F.count("CRASH_UNIT_ID").alias("Cnt_Entities_Accid"),
        F.count("VEHICLE_ID").alias("Cnt_MotorVehicles_Accid"),
        *[F.max(c).alias(c) for c in vehicle_slot_columns(n)],
    )
    return out.select(*vehicle_summary_columns(n))


def _vehicle_slot_groups(vehicles: DataFrame, n: int) -> DataFrame:
    """The inner GROUP BY of the compat summary: (crash, RD_NO, date, slots) -> counts.

    Every row counts towards the no-slot group of its (crash, RD_NO, date); rows whose
    keys hold a slot (``slot_rows``) are taken off it again and counted in their own group. The
    counts are combined before their shuffle: a third of all rows in one crash is a few rows per
    map task. Both sides are clustered by the crash join keys, where a crash has few rows; only
    after that is a row with a slot doubled, and the groups need no shuffle of their own.
    """
    keys = JOIN_KEYS
    slot_cols = vehicle_slot_columns(n)
    unit, vehicle = _flag(F.col("CRASH_UNIT_ID")), _flag(F.col("VEHICLE_ID"))
    every = vehicles.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.sum(unit).alias("_u"), F.sum(vehicle).alias("_v"))
    every = every.select(*keys, *null_slots(n), "_rows", "_u", "_v")
    matched = slot_rows(vehicles, n).repartition(*keys)
    copies = F.col(COPIES)
    plus = F.struct(*[F.col(c) for c in slot_cols], F.lit(1).cast("bigint").alias("_sign"))
    minus = F.struct(*null_slots(n), F.lit(-1).cast("bigint").alias("_sign"))
    moved = matched.select(*keys, unit.alias("_u"), vehicle.alias("_v"), copies, F.explode(F.array(plus, minus)).alias("s"))
    signed = F.col("s._sign") * copies
    moved = moved.select(
        *keys, *[F.col(f"s.{c}").alias(c) for c in slot_cols], signed.alias("_rows"),
        (signed * F.col("_u")).alias("_u"), (signed * F.col("_v")).alias("_v"))
    out = every.unionByName(moved).groupBy(*keys, *slot_cols).agg(
        F.sum("_rows").alias("_rows"),
        F.sum("_u").alias("Cnt_Entities_Accid"),
        F.sum("_v").alias("Cnt_MotorVehicles_Accid"),
    )
    return out.filter(F.col("_rows") > 0).drop("_rows")


def _vehicle_summary_fixed(vehicles: DataFrame, n: int, slot_null_vehicle: bool) -> DataFrame:
    slot_cols = vehicle_slot_columns(n)
    base = vehicles.select(
        "CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", *null_slots(n),
        _flag(F.col("CRASH_UNIT_ID")).alias("_u"), _flag(F.col("VEHICLE_ID")).alias("_v"),
    )
    # not only rows with an id: a unit without CRASH_UNIT_ID still shows its make and model
    held = own_slots(slot_candidates(vehicles, n), n, slot_null_vehicle)
    holders = held.select(
        "CRASH_RECORD_ID", F.lit(None).cast("string").alias("RD_NO"),
        F.lit(None).cast(vehicles.schema["CRASH_DATE"].dataType).alias("CRASH_DATE"),
        *slot_cols, F.lit(0).cast("bigint").alias("_u"), F.lit(0).cast("bigint").alias("_v"),
    )
    out = base.unionByName(holders).groupBy("CRASH_RECORD_ID").agg(
        F.max("RD_NO").alias("RD_NO"),
        F.max("CRASH_DATE").alias("CRASH_DATE"),
        F.sum("_u").alias("Cnt_Entities_Accid"),
        F.sum("_v").alias("Cnt_MotorVehicles_Accid"),
        *[F.max(c).alias(c) for c in slot_cols],
    )
    return out.select(*vehicle_summary_columns(n))


def vehicle_pivot(
    vehicles: DataFrame, n: int = SLOT_COUNT, strategy: str = "auto", hot_rows: int = DEFAULT_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One row per (crash, RD_NO, date) with the slot triples (no counts)."""
    if strategy == "auto":
        return route_hot(
            vehicles, CRASH_KEY,
            lambda df: _vehicle_pivot(df, n, "window"),
            lambda df: _vehicle_pivot(df, n, "topk"),
            hot_rows, hot,
        )
    return _vehicle_pivot(vehicles, n, strategy)


def _vehicle_pivot(vehicles: DataFrame, n: int, strategy: str) -> DataFrame:
    keys = ["CRASH_RECORD_ID", "RD_NO", "CRASH_DATE"]
    if strategy == "window":
        rows = vehicle_slots(vehicles, n, strategy=strategy).select(*keys, *vehicle_slot_columns(n))
    else:
        # Every unit row names its group; slot-holding rows add their values.
        base = vehicles.select(*keys, *null_slots(n))
        rows = base.unionByName(slot_rows(vehicles, n).select(*keys, *vehicle_slot_columns(n)))
    out = rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in vehicle_slot_columns(n)])
    return out.select(*vehicle_pivot_columns(n))


def multi_vehicle_crashes(vehicles: DataFrame, minimum: int = 2) -> DataFrame:
    """Crashes with at least ``minimum`` units (GROUP BY + HAVING on the count alias)."""
    counts = vehicles.groupBy("CRASH_RECORD_ID").agg(F.count("CRASH_UNIT_ID").alias("num_vehicles"))
    return counts.filter(F.col("num_vehicles") >= minimum)


# --------------------------------------------------------------------------- people
# A driver, as the studied job's self-joins identify one.
DRIVER_KEY = ["CRASH_RECORD_ID", "CRASH_DATE", "PERSON_ID"]


def _slot_values(keyed: Column) -> list[Column]:
    """What a driver row puts into a slot: sex, age, injury, and what slot 1 shows as
    injury (the age, 'NA' where the injury is missing). Unkeyed rows show 'NA' only."""
    injury = F.when(keyed, F.col("INJURY_CLASSIFICATION"))
    return [
        na_text(F.when(keyed, F.col("SEX"))).alias("_sex"),
        na_text(F.when(keyed, F.col("AGE"))).alias("_age"),
        F.when(injury.isNull(), F.lit("NA")).otherwise(F.col("AGE").cast("string")).alias("_inj_first"),
        na_text(injury).alias("_inj_rest"),
    ]


def _power(c: Column, k: int) -> Column:
    out = c.cast("decimal(38,0)")
    for _ in range(k - 1):
        out = F.try_multiply(out, c.cast("decimal(19,0)")).cast("decimal(38,0)")
    return out


def _product(factors: list[Column]) -> Column:
    out = factors[0].cast("decimal(38,0)")
    for f in factors[1:]:
        out = F.try_multiply(out, f.cast("decimal(19,0)")).cast("decimal(38,0)")
    return out


_LONG_MAX = 2**63 - 1


def _as_count(c: Column) -> Column:
    """A product as bigint; beyond bigint's range it stays at its end."""
    top = F.lit(_LONG_MAX).cast("decimal(38,0)")
    return F.coalesce(F.least(c, top), top).cast("bigint")


def _with_copies(variants: Column, fields: list[str]) -> Column:
    """The distinct values of ``fields`` among a driver's variants, each with its copies ``m``."""
    def value(v: Column) -> Column:
        return F.struct(*[v[f].alias(f) for f in fields])

    def counted(k: Column) -> Column:
        same = F.filter(variants, lambda v: value(v).eqNullSafe(k))
        return F.struct(*[k[f].alias(f) for f in fields], _sum_counts(same).alias("m"))

    single = F.array(F.struct(*[variants[0][f].alias(f) for f in fields], variants[0]["c"].alias("m")))
    return F.when(F.size(variants) == 1, single).otherwise(
        F.transform(F.array_distinct(F.transform(variants, value)), counted))


def person_slots(
    people: DataFrame, n: int = SLOT_COUNT, driver_type: str = "Driver", expand: bool = True
) -> DataFrame:
    """Drivers with the compat person-slot columns.

    The studied job left-joins the drivers to themselves n times on (crash, date,
    PERSON_ID), without any sequence filter: a driver fills all n slots with its own values
    ('NA' for NULL text; slot 1's injury column carries the age), and a driver that occurs
    c times gives every combination of its rows, c ** (n + 1) in all. A driver with a NULL
    key matches nothing and gets a NULL id and 'NA' everywhere else.

    Copies are counted, not multiplied row by row: distinct combinations carry their number
    of occurrences, which ``expand`` turns into that many rows and ``expand=False`` returns
    as ``copies``.
    """
    keyed = F.col("CRASH_RECORD_ID").isNotNull() & F.col("CRASH_DATE").isNotNull() & F.col("PERSON_ID").isNotNull()
    raw = ["SEX", "AGE", "INJURY_CLASSIFICATION"]
    rows = filter_drivers(people, driver_type).select(*DRIVER_KEY, "RD_NO", *[F.when(keyed, F.col(c)).alias(c) for c in raw])
    # Copies are combined before the shuffle; what slots show is worked out after it, from fewer
    # and narrower columns. Rows without a whole key stay apart by RD_NO.
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_c"))
    sex, age, first, rest = _slot_values(keyed)
    each = rows.groupBy(*DRIVER_KEY, F.when(~keyed, F.struct("RD_NO")).alias("_apart")).agg(F.collect_list(F.struct(
        F.col("RD_NO").alias("rd"), sex.alias("sex"), age.alias("age"), first.alias("first"), rest.alias("rest"),
        F.col("_c").alias("c"))).alias("_v"))

    # A combination takes an RD_NO and one (sex, age, injury) per slot and occurs as often as the
    # product of their copies. They are exploded a slot at a time: no array is longer than the
    # driver's distinct rows.
    made = each.select(*DRIVER_KEY, "_v", F.explode(_with_copies(F.col("_v"), ["rd"])).alias("_x0"))
    for k in range(1, n + 1):
        made = made.select("*", F.explode(_with_copies(F.col("_v"), ["sex", "age", "first" if k == 1 else "rest"])).alias(f"_x{k}"))
    copies = F.when(keyed, _product([F.col(f"_x{k}.m") for k in range(n + 1)])).otherwise(
        F.col("_x0.m").cast("decimal(38,0)"))
    shown = [c for k in range(1, n + 1) for c in (
        F.when(keyed, F.col("PERSON_ID")).alias(f"PERSON{k}_ID"), F.col(f"_x{k}.sex").alias(f"PERSON{k}_SEX"),
        F.col(f"_x{k}.age").alias(f"PERSON{k}_AGE"),
        F.col(f"_x{k}.{'first' if k == 1 else 'rest'}").alias(f"PERSON{k}_INJURY_CLASSIFICATION"))]
    out = made.select("PERSON_ID", "CRASH_RECORD_ID", F.col("_x0.rd").alias("RD_NO"), "CRASH_DATE", *shown,
                      _as_count(copies).alias("copies"))
    if not expand:
        return out
    # Two steps, so that no row makes an array of more than 2 ** 16 elements.
    step = 1 << 16
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / step)))
    out = out.withColumn("_chunk", chunk)
    size = F.least(F.lit(step).cast("bigint"), F.col("copies") - F.col("_chunk") * step)
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), size.cast("int")))).drop("copies", "_chunk", "_copy")


def people_summary(
    people: DataFrame,
    compat: bool = True,
    n: int = SLOT_COUNT,
    driver_type: str = "Driver",
    strategy: str = "auto",
    hot_rows: int = DEFAULT_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Drivers per crash: a driver count plus n person slots.

    compat: two GROUP BYs over ``person_slots`` — first (crash, RD_NO, date, slots) with
    the count, then (crash, date, RD_NO, count) with ``max`` per slot column (text max,
    so '9' > '10' and 'NA' > any digit). Drivers that occur more than once multiply as
    the self-joins do, copies or not; the products are taken over distinct
    multiplicities, never over rows.
    corrected: one row per crash, drivers ordered by PERSON_ID, slot k = k-th driver.

    strategy: ``cluster`` shuffles the drivers once by (crash, date) and does the rest
    locally; ``partial`` lets every GROUP BY pre-aggregate before its shuffle (no task
    holds a whole crash); ``auto`` uses ``partial`` for crashes with >= ``hot_rows``
    drivers only.
    """
    summarise = _people_summary_compat if compat else _people_summary_fixed
    if strategy == "auto":
        return route_hot(
            filter_drivers(people, driver_type), CRASH_KEY,
            lambda df: summarise(df, n, driver_type, "cluster"),
            lambda df: summarise(df, n, driver_type, "partial"),
            hot_rows, hot=hot,
        )
    return summarise(people, n, driver_type, strategy)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def _sum_counts(rows: Column) -> Column:
    return F.aggregate(rows, F.lit(0).cast("bigint"), lambda x, v: x + v["c"])


def _slot_choices(variants: Column, injury: str) -> Column:
    """What a slot of a repeated driver can show: for each number of copies that some (sex, age,
    injury) has among the variants, the maxima of the values with that number."""
    def value(v: Column) -> Column:
        return F.struct(v["sex"].alias("sex"), v["age"].alias("age"), v[injury].alias("inj"))

    each = F.transform(F.array_distinct(F.transform(variants, value)), lambda k: F.struct(
        _sum_counts(F.filter(variants, lambda v: value(v) == k)).alias("m"), k.alias("k")))

    def best(all_: Column, m: Column, field: str) -> Column:
        return F.array_max(F.transform(F.filter(all_, lambda x: x["m"] == m), lambda x: x["k"][field])).alias(field)

    return _let(each, lambda e: F.transform(
        F.array_distinct(F.transform(e, lambda x: x["m"])),
        lambda m: F.struct(m.alias("m"), *[best(e, m, f) for f in ("sex", "age", "inj")])))


def _combinations(variants: Column, n: int) -> Column:
    """Rows of a repeated driver after the self-joins, as (rd, count, slots): a combination
    takes an RD_NO and a choice per slot, and occurs as often as the product of their copies."""
    rds = F.transform(F.array_distinct(F.transform(variants, lambda v: F.struct(v["rd"].alias("rd")))), lambda r: F.struct(
        r["rd"].alias("rd"),
        _sum_counts(F.filter(variants, lambda v: v["rd"].eqNullSafe(r["rd"]))).cast("decimal(38,0)").alias("count"),
        F.array().cast("array<struct<sex:string,age:string,inj:string>>").alias("slots")))

    def with_slot(made: Column, choices: Column) -> Column:
        return F.flatten(F.transform(made, lambda x: F.transform(choices, lambda y: F.struct(
            x["rd"].alias("rd"), F.try_multiply(x["count"], y["m"].cast("decimal(19,0)")).cast("decimal(38,0)").alias("count"),
            F.concat(x["slots"], F.array(F.struct(y["sex"].alias("sex"), y["age"].alias("age"), y["inj"].alias("inj")))).alias("slots")))))

    def all_slots(rest: Column) -> Column:
        made = _let(_slot_choices(variants, "first"), lambda c: with_slot(rds, c))
        for _ in range(n - 1):
            made = with_slot(made, rest)
        return made

    return _let(_slot_choices(variants, "rest"), all_slots)


def _people_summary_compat(people: DataFrame, n: int, driver_type: str, strategy: str) -> DataFrame:
    """One pass: distinct driver rows with their copies, an array of variants per driver, its
    combinations worked out in place, and one GROUP BY over them."""
    drivers = filter_drivers(people, driver_type)
    keyed = F.col("CRASH_RECORD_ID").isNotNull() & F.col("CRASH_DATE").isNotNull() & F.col("PERSON_ID").isNotNull()
    raw = ["SEX", "AGE", "INJURY_CLASSIFICATION"]
    # Raw columns are shuffled, and what slots show is worked out after: they are fewer and narrower.
    rows = drivers.select("CRASH_RECORD_ID", "CRASH_DATE", "RD_NO", F.when(keyed, F.col("PERSON_ID")).alias("_id"),
                          F.col("PERSON_ID").isNotNull().cast("bigint").alias("_named"),
                          *[F.when(keyed, F.col(c)).alias(c) for c in raw])
    if strategy == "cluster":
        rows = rows.repartition("CRASH_RECORD_ID", "CRASH_DATE")
    group = ["CRASH_RECORD_ID", "CRASH_DATE"]
    rows = rows.groupBy(*group, "RD_NO", "_id", *raw).agg(
        F.count(F.lit(1)).alias("_c"), F.sum("_named").alias("_named"))
    sex, age, first, rest = _slot_values(F.col("_id").isNotNull())
    # Rows without a whole key are one row per RD_NO already and stay apart by it.
    each = rows.groupBy(*group, "_id", F.when(F.col("_id").isNull(), F.struct("RD_NO")).alias("_apart")).agg(
        F.collect_list(F.struct(
            F.col("RD_NO").alias("rd"), sex.alias("sex"), age.alias("age"), first.alias("first"), rest.alias("rest"),
            F.col("_c").alias("c"), F.col("_named").alias("named"))).alias("_v"))
    if strategy == "partial":
        # Written, so that the shuffles of the drivers do not stay beside that of their slots.
        from wreckline.sources.sinks import stage_parquet  # sources import the operators

        each = stage_parquet(each, name="drivers")
    one = F.col("_v")[0]

    def shown(injury: str) -> Column:
        return F.struct(one["sex"].alias("sex"), one["age"].alias("age"), one[injury].alias("inj"))

    single = F.array(F.struct(
        one["rd"].alias("rd"),
        F.when(F.col("_id").isNull(), one["named"].cast("decimal(38,0)")).otherwise(_power(one["c"], n + 1)).alias("count"),
        F.array(shown("first"), *[shown("rest")] * (n - 1)).alias("slots")))
    made = F.when(F.size("_v") == 1, single).otherwise(_combinations(F.col("_v"), n))
    count = "Cnt_Drivers_Accid"
    # Slots from the second on have the same choices, in every combination, so that their maxima
    # are the same: the second stands for them.
    kept = range(1, min(n, 2) + 1)
    flat = each.select(*group, "_id", F.explode(made).alias("_m")).select(
        *group, F.col("_m.rd").alias("RD_NO"), _as_count(F.col("_m.count")).alias(count), "_id",
        *[F.col("_m.slots")[k - 1][f].alias(f"_{f}{k}") for k in kept for f in ("sex", "age", "inj")])
    out = flat.groupBy(*group, "RD_NO", count).agg(
        F.max("_id").alias("_id"), *[F.max(f"_{f}{k}").alias(f"_{f}{k}") for k in kept for f in ("sex", "age", "inj")])
    names = {"ID": "_id", "SEX": "_sex{}", "AGE": "_age{}", "INJURY_CLASSIFICATION": "_inj{}"}
    return out.select(*group, "RD_NO", count, *[
        F.col(c.format(min(k, 2))).alias(f"PERSON{k}_{field}") for k in range(1, n + 1) for field, c in names.items()
    ]).select(*people_summary_columns(n))


# Ties between equal PERSON_IDs are broken by these, so slots are deterministic.
PERSON_TIE_BREAKERS = ["CRASH_DATE", "RD_NO", "SEX", "AGE", "INJURY_CLASSIFICATION"]


def _driver_slot_values(n: int, seq: Column) -> list[Column]:
    cols = []
    for k in range(1, n + 1):
        for field, value in (("ID", F.col("PERSON_ID")), ("SEX", na_text(F.col("SEX"))),
                             ("AGE", na_text(F.col("AGE"))),
                             ("INJURY_CLASSIFICATION", na_text(F.col("INJURY_CLASSIFICATION")))):
            cols.append(F.when(seq == k, value).alias(f"PERSON{k}_{field}"))
    return cols


def _driver_order(drivers: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ["PERSON_ID"] + PERSON_TIE_BREAKERS if c in drivers.columns]


def _people_summary_fixed(people: DataFrame, n: int, driver_type: str, strategy: str) -> DataFrame:
    """Corrected summary. ``cluster``: one shuffle, drivers numbered per crash and grouped
    locally. ``partial``: the first n drivers by a row-number limit that runs before the
    shuffle, every driver only counted, both combined in one aggregation."""
    drivers = filter_drivers(people, driver_type)
    numbered = drivers.withColumn(
        "_seq", F.row_number().over(Window.partitionBy(CRASH_KEY).orderBy(*_driver_order(drivers))))
    slot_cols = person_slot_columns(n)
    if strategy == "cluster":
        rows = numbered.select(
            "CRASH_RECORD_ID", "CRASH_DATE", "RD_NO", _flag(F.col("PERSON_ID")).alias("_p"),
            *_driver_slot_values(n, F.col("_seq")))
    else:
        holders = numbered.filter(F.col("_seq") <= n).select(
            "CRASH_RECORD_ID", F.lit(None).cast(people.schema["CRASH_DATE"].dataType).alias("CRASH_DATE"),
            F.lit(None).cast("string").alias("RD_NO"), F.lit(0).cast("bigint").alias("_p"),
            *_driver_slot_values(n, F.col("_seq")))
        base = drivers.select(
            "CRASH_RECORD_ID", "CRASH_DATE", "RD_NO", _flag(F.col("PERSON_ID")).alias("_p"),
            *[F.lit(None).cast("string").alias(c) for c in slot_cols])
        rows = base.unionByName(holders)
    out = rows.groupBy("CRASH_RECORD_ID").agg(
        F.max("CRASH_DATE").alias("CRASH_DATE"),
        F.max("RD_NO").alias("RD_NO"),
        F.sum("_p").alias("Cnt_Drivers_Accid"),
        *[F.max(c).alias(c) for c in slot_cols],
    )
    return out.select(*people_summary_columns(n))


__all__ = ["vehicle_summary", "vehicle_pivot", "multi_vehicle_crashes", "person_slots", "people_summary"]
