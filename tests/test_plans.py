"""Physical-plan properties that matter at scale (checked on Parquet input)."""

from __future__ import annotations

import contextlib
import io

import pytest

from wreckline.operators import (
    number_units,
    people_summary,
    vehicle_summary,
    vehicles_of_crash,
)
from wreckline.operators.skew import hot_keys
from wreckline.plans import vehicle_person_detail
from wreckline.sources import crash_tables, load_crashes, load_people, load_vehicles, write_parquet
from conftest import SF_SMOKE  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("landed"))
    c, v, p = crash_tables(spark, SF_SMOKE)
    for name, df in (("crash", c), ("vehicles", v), ("people", p)):
        write_parquet(df, f"{base}/{name}")
    return (load_crashes(spark, f"{base}/crash"), load_vehicles(spark, f"{base}/vehicles"),
            load_people(spark, f"{base}/people"))


def test_topk_summary_has_no_join_and_limits_before_shuffle(landed):
    _, v, _ = landed
    text = formatted(vehicle_summary(v, strategy="topk"))
    assert "Join" not in text
    # the rank filter runs partially before the shuffle
    head = text.split("\n\n")[0]
    lines = head.splitlines()
    partial_idx = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    assert partial_idx, text
    assert "Partial" in text


def _exchanges(df) -> list[str]:
    return [line for line in formatted(df).splitlines() if line.startswith("Arguments: ")
            and ("hashpartitioning" in line or "rangepartitioning" in line)]


def test_window_summary_shuffles_units_once(landed):
    _, v, _ = landed
    ex = _exchanges(vehicle_summary(v, strategy="window"))
    # the units once (for the window); then only the few inner groups per crash are
    # regrouped by the crash join keys, which the outer GROUP BY reuses
    assert len(ex) == 2, ex
    assert sum("REPARTITION_BY_COL" in e for e in ex) == 1


def _ran(df) -> str:
    """The plan after adaptive execution ran it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> int:
    return sum("FileScan parquet" in line or "Scan parquet" in line for line in plan.splitlines())


def _final(df) -> tuple[int, list[str]]:
    final = _ran(df).split("== Initial Plan ==")[0]
    return _scans(final), [line for line in final.splitlines() if " Exchange hashpartitioning" in line]


def test_without_hot_crashes_the_plain_plan_is_all_there_is(landed):
    from wreckline.operators.skew import HotKeys
    from wreckline.plans import crash_summary, crash_vehicle_summary

    c, v, p = landed
    none = HotKeys()
    scans, ex = _final(crash_summary(c, v, p, hot=none))
    assert scans == 3 and len(ex) <= 6, (scans, ex)  # each table read once
    scans, ex = _final(crash_vehicle_summary(c, v, hot=none))
    assert scans == 2 and len(ex) <= 4, (scans, ex)
    scans, ex = _final(vehicle_person_detail(c, v, p, hot=none))
    assert scans == 3 and len(ex) <= 3, (scans, ex)
    scans, ex = _final(number_units(v, hot=none))
    assert scans == 1 and len(ex) == 1


def test_with_hot_crashes_each_table_is_read_twice_at_most(landed):
    from wreckline.operators.skew import HotKeys
    from wreckline.plans import crash_summary

    c, v, p = landed
    hot = HotKeys(("1", "7"))
    scans, _ = _final(vehicle_person_detail(c, v, p, hot=hot))
    assert scans <= 6, scans
    scans, _ = _final(people_summary(p, hot=hot))
    assert scans <= 2, scans
    got = crash_summary(c, v, p, hot=hot)
    assert rows_of(got) == rows_of(crash_summary(c, v, p, hot=HotKeys()))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_driver_summary_is_one_scan_and_three_exchanges(landed):
    _, _, p = landed
    for strategy, most in (("cluster", 1), ("partial", 3)):
        scans, ex = _final(people_summary(p, strategy=strategy))
        assert scans == 1 and len(ex) <= most, (strategy, scans, ex)


def test_zone_keeps_a_list_of_hot_crashes(spark, tmp_path):
    from wreckline.operators.skew import HotKeys
    from wreckline.sources.hot_list import load_hot_keys, write_hot_list

    rows = [("hot",)] * 30 + [("warm",)] * 12 + [("cold",)] + [(None,)] * 15
    one = spark.createDataFrame(rows, "CRASH_RECORD_ID string")
    other = spark.createDataFrame([("b",)] * 40, "CRASH_RECORD_ID string")
    root = str(tmp_path)
    assert load_hot_keys(spark, root) is None  # no list: operators count for themselves
    write_hot_list(spark, root, {"vehicles": one, "people": other, "crash": one.limit(0)}, min_rows=10)
    assert load_hot_keys(spark, root, 10) == HotKeys(("b", "hot", "warm"), True)
    assert load_hot_keys(spark, root, 20) == HotKeys(("b", "hot"), False)
    assert load_hot_keys(spark, root, 100) == HotKeys() and load_hot_keys(spark, root, 5) is None
    assert spark.read.parquet(f"{root}/hot_crash_ids").count() == 3 + 3


def test_crash_summary_shuffles_each_input_once(landed):
    from wreckline.plans import crash_summary

    c, v, p = landed
    scans, ex = _final(crash_summary(c, v, p, strategy="window"))
    assert scans == 3 and len(ex) <= 6, (scans, ex)


def test_point_lookup_is_pushed_to_the_scan(landed):
    _, v, _ = landed
    text = formatted(vehicles_of_crash(v, "7"))
    assert "PushedFilters: [IsNotNull(CRASH_RECORD_ID), EqualTo(CRASH_RECORD_ID,7)]" in text


def test_driver_filter_is_pushed_to_the_scan(landed):
    _, _, p = landed
    text = formatted(people_summary(p, strategy="cluster"))
    assert "EqualTo(PERSON_TYPE,Driver)" in text


def test_scans_read_only_needed_columns(landed):
    c, v, p = landed
    text = formatted(vehicle_person_detail(c, v, p))
    assert "ReadSchema: struct<CRASH_UNIT_ID:bigint,CRASH_RECORD_ID:string,CRASH_DATE:timestamp_ntz," \
           "UNIT_TYPE:string,VEHICLE_ID:bigint,MAKE:string,MODEL:string>" in text
    assert "NUM_PASSENGERS" not in text and "Window" not in text


@pytest.mark.parametrize("sample", [20_000, 50])
def test_numbering_by_bounds_equals_window_numbering(spark, monkeypatch, sample):
    monkeypatch.setattr("wreckline.operators.sequence.SAMPLE", sample)
    big = 2**62
    rows = [("hot", u * 40_000, None) for u in range(500)] + [("hot", u, None) for u in (None, None, -1, -big, big, big - 1)]
    rows += [("hot", 7, None)] * 300 + [("cold", u, None) for u in range(7)] + [(None, 1, None), (None, None, 3)]
    df = spark.createDataFrame(rows, "CRASH_RECORD_ID string, CRASH_UNIT_ID bigint, VEHICLE_ID bigint").repartition(4)
    key = lambda r: tuple(str(x) for x in r)
    plain = sorted(number_units(df, skew_safe=False).collect(), key=key)
    assert plain == sorted(number_units(df, skew_safe=True).collect(), key=key)
    assert plain == sorted(number_units(df, hot_rows=100).collect(), key=key)
    assert sorted(r.veh_seq_nbr for r in plain if r.CRASH_RECORD_ID == "hot") == list(range(1, 807))


def test_units_without_an_id_are_numbered_in_many_tasks(spark):
    from pyspark.sql import functions as F

    rows = spark.range(60_000).select(
        F.lit("hot").alias("CRASH_RECORD_ID"), F.lit(None).cast("bigint").alias("CRASH_UNIT_ID"), F.col("id").alias("VEHICLE_ID"))
    df = number_units(rows, skew_safe=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as where partitions are large
    try:
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    numbered = df.where("veh_seq_nbr = VEHICLE_ID + 1").count()
    assert numbered == 60_000 and len(sizes) > 1 and max(r["count"] for r in sizes) < 40_000
    scans, ex = _final(df)
    assert scans <= 6 and len(ex) <= 4, (scans, ex)


def test_hot_keys_are_exact_and_never_null(spark):
    from wreckline.operators.skew import HotKeys, count_hot, split_hot

    rows = [("hot", u) for u in range(300)] + [(f"c{i}", 1) for i in range(50)] + [(None, 1)] * 500
    df = spark.createDataFrame(rows, "CRASH_RECORD_ID string, CRASH_UNIT_ID bigint")
    names = lambda d: sorted(r[0] for r in d.collect())
    assert names(hot_keys(df, "CRASH_RECORD_ID", min_rows=100)) == ["hot"]
    assert len(names(hot_keys(df, "CRASH_RECORD_ID", min_rows=1))) == 51  # any number of keys
    crashes = spark.createDataFrame([("b", 1)] * 200 + [("c", 1)], "CRASH_RECORD_ID string, x bigint")
    assert count_hot([df, crashes], "CRASH_RECORD_ID", 100) == HotKeys(("b", "hot"), True)
    assert count_hot([df, crashes], "CRASH_RECORD_ID", 1000) == HotKeys() and not HotKeys()
    for hot, want in ((HotKeys(("hot",), True), (50, 800)), (HotKeys(("hot",)), (550, 300)), (HotKeys((), True), (350, 500)),
                      (HotKeys(("hot", *map(str, range(2000))), True), (50, 800)), (HotKeys(("hot", *map(str, range(2000)))), (550, 300))):
        cold, rest = split_hot(df, "CRASH_RECORD_ID", hot)
        assert (cold.count(), rest.count()) == want, hot


def test_detail_of_hot_crashes_stays_spread(spark, landed):
    c, v, p = landed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale
    try:
        df = vehicle_person_detail(c, v, p, strategy="spread")
        ex, text = _exchanges(df), formatted(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # each side de-duplicated before its first shuffle (partial aggregation, so copies of
    # a row cost one row per map task); units and people then meet on (crash, unit, date).
    # The join with the crash attributes is an ordinary one, whose skewed partitions
    # adaptive execution splits.
    keys = [e.split("hashpartitioning(")[1].rsplit(",", 1)[0] for e in ex]
    by_crash_and_date = [k for k in keys if k.count(",") < 2]
    assert all("ENSURE_REQUIREMENTS" in e for e in ex), ex
    assert len(by_crash_and_date) <= 2, keys
    assert text.count("HashAggregate") >= 6  # partial + final per side


def test_detail_shuffles_each_input_once(spark, landed):
    c, v, p = landed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ex = _exchanges(vehicle_person_detail(c, v, p, strategy="shuffle"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # units, people and crashes clustered by (crash, date) once; the unit-person join,
    # the crash join and the final de-duplication all reuse it
    assert len(ex) == 3, ex
    assert not any("CRASH_UNIT_ID" in e or "_p_unit" in e for e in ex), ex


def test_keys_too_many_for_the_driver_stay_a_table(spark, landed, monkeypatch):
    from wreckline.operators import skew
    from wreckline.plans import crash_summary

    c, v, p = landed
    plain = sorted(map(str, crash_summary(c, v, p, hot_rows=5).collect()))
    rows = [(f"k{i}", n) for i in range(1500) for n in range(2)] + [("one", 1)] + [(None, 1)] * 3
    df = spark.createDataFrame(rows, "CRASH_RECORD_ID string, n int")
    hot = skew.count_hot([df], "CRASH_RECORD_ID", 2)
    assert hot.keys == () and hot.nulls and hot.listed.count() == 1500
    cold, rest = skew.split_hot(df, "CRASH_RECORD_ID", hot)
    assert ([r[0] for r in cold.collect()], rest.count()) == (["one"], 3003)
    monkeypatch.setattr(skew, "_AS_LITERALS", 3)
    monkeypatch.setattr(skew, "_NO_BROADCAST", 3)
    assert skew.count_hot([c, v], "CRASH_RECORD_ID", 5).listed is not None
    made = crash_summary(c, v, p, hot_rows=5)
    assert sorted(map(str, made.collect())) == plain
    assert "_hot_key" not in " ".join(x for x in formatted(made).splitlines() if "BroadcastExchange" in x)


def test_hot_list_is_counted_in_many_tasks(spark):
    from wreckline.sources.hot_list import hot_list

    df = spark.range(1000).selectExpr("cast(id % 10 as string) CRASH_RECORD_ID")
    made = hot_list({"crash": df, "people": df}, min_rows=50)
    # the counted ids are filtered before the one partition is made, by a shuffle
    assert "Coalesce" not in formatted(made) and made.rdd.getNumPartitions() == 1
    assert made.filter("key is not null").count() == 20


def test_derived_lines_are_shuffled_once_with_their_orders(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale
    try:
        plans = [formatted(df) for df in crash_tables(spark, SF_SMOKE)[1:]]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in plans:
        by_order = [x for x in text.splitlines() if x.startswith("Arguments: hashpartitioning") and "orderkey" in x]
        assert len(by_order) == 2 and "hashpartitioning(CRASH_RECORD_ID" not in text
        shuffled = [x for x in text.splitlines() if x.startswith("Input") and "CRASH_RECORD_ID" in x]
        assert shuffled == [] or all("Exchange" not in x for x in shuffled)


def test_landed_zone_is_clustered_and_drops_are_small(spark, tmp_path):
    import glob

    from pyspark.sql import functions as F
    from wreckline.sources import land_crash_tables
    from wreckline.sources.derived import exported_csv

    root = land_crash_tables(spark, SF_SMOKE, str(tmp_path))
    for name, df in zip(("crash", "vehicles", "people"), crash_tables(spark, SF_SMOKE), strict=True):
        back = spark.read.parquet(f"{root}/{name}")
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        files = back.withColumn("_file", F.input_file_name()).groupBy("CRASH_RECORD_ID").agg(F.countDistinct("_file").alias("n"))
        assert files.filter("n > 1").count() == 0
    for path in exported_csv(spark, SF_SMOKE).values():
        assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")


def test_person_slots_shuffles_drivers_twice(landed):
    from wreckline.operators import person_slots

    _, _, p = landed
    text = formatted(person_slots(p))
    # once with copies combined, once by driver; no join of the drivers with themselves
    assert len(_exchanges(person_slots(p))) == 2 and "Join" not in text


def test_tables_meet_a_long_list_once(spark, landed, monkeypatch):
    from wreckline.operators import skew
    from wreckline.plans import crash_summary

    monkeypatch.setattr(skew, "_AS_LITERALS", 3)
    monkeypatch.setattr(skew, "_NO_BROADCAST", 3)
    rows = [(f"k{i}", n) for i in range(20) for n in range(2)] + [("one", 1)] + [(None, 1)] * 3
    df = spark.createDataFrame(rows, "CRASH_RECORD_ID string, n int")
    # Keys that are hot in two tables are listed once: rows that meet them are not doubled.
    hot = skew.count_hot([df, df], "CRASH_RECORD_ID", 2)
    assert hot.shuffled and hot.listed.count() == 20
    cold, rest = skew.split_hot(df, "CRASH_RECORD_ID", hot)
    assert rows_of(cold) == rows_of(df.filter("CRASH_RECORD_ID = 'one'"))
    assert rows_of(rest) == rows_of(df.filter("CRASH_RECORD_ID <> 'one' OR CRASH_RECORD_ID IS NULL"))
    none = skew.split_hot(df.limit(0), "CRASH_RECORD_ID", hot)
    assert [x.count() for x in none] == [0, 0]
    c, v, p = landed
    assert "_hot_key" not in formatted(crash_summary(c, v, p, hot_rows=5))


def test_driver_summary_shuffles_narrow_rows(landed):
    _, _, p = landed
    for strategy in ("cluster", "partial"):
        text = formatted(people_summary(p, strategy=strategy))
        # raw columns, and two slots that stand for all four
        assert "_inj_rest" not in text and "_sex2" in text and "_sex3" not in text
    one, two, three = (people_summary(p, n=n).drop("Cnt_Drivers_Accid") for n in (1, 2, 3))
    assert rows_of(two.select(one.columns)) == rows_of(one)
    assert rows_of(three.select(two.columns)) == rows_of(two)


def test_slot_groups_are_not_shuffled_by_their_slots(landed):
    _, v, _ = landed
    ex = _exchanges(vehicle_summary(v, strategy="topk"))
    assert len(ex) <= 5 and not any("VEHICLE1" in e for e in ex), ex
    text = formatted(vehicle_summary(v, strategy="lookup"))
    assert "Join" not in text and len(_exchanges(vehicle_summary(v, strategy="lookup"))) == 1
