"""CSV landing (strict and quarantined), Parquet / catalog sinks, output contract."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from wreckline.operators import apply_output_contract, assert_unique_key, sanitize_columns
from wreckline.operators.contract import CRASH_SUMMARY_CONTRACT
from wreckline.sources import (
    csv_quarantine,
    csv_to_parquet,
    ingest_datasets,
    publish_table,
    read_csv_table,
    read_with_schema,
    register_external,
    stage_parquet,
    write_parquet,
    write_table,
)
from wreckline.sources.ingest import EmptyCsvError, TooManyRejectedError

SCHEMA = T.StructType([
    T.StructField("CRASH_RECORD_ID", T.StringType()),
    T.StructField("CRASH_DATE", T.TimestampNTZType()),
    T.StructField("INJURIES_TOTAL", T.LongType()),
])
GOOD = "CRASH_RECORD_ID,CRASH_DATE,INJURIES_TOTAL\na1,04/22/2022 10:30:00 PM,1\na2,2022-04-23 08:00:00,0\n"


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return str(path)


def test_csv_to_parquet_same_stem(spark, tmp_path):
    src = _write(tmp_path / "crash.csv", "CRASH_RECORD_ID,INJURIES_TOTAL\na1,1\na2,0\n")
    out = csv_to_parquet(spark, src, schema=T.StructType(SCHEMA.fields[::2]))
    assert out.endswith("crash.parquet")
    assert sorted(r.INJURIES_TOTAL for r in spark.read.parquet(out).collect()) == [0, 1]


def test_ragged_row_fails_strict_ingest(spark, tmp_path):
    src = _write(tmp_path / "bad.csv", "CRASH_RECORD_ID,INJURIES_TOTAL\na1,1\na2,0,extra,cols\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        csv_to_parquet(spark, src, schema=T.StructType(SCHEMA.fields[::2]))


def test_empty_and_non_csv_sources(spark, tmp_path):
    with pytest.raises(EmptyCsvError):
        csv_to_parquet(spark, _write(tmp_path / "empty.csv", ""))
    txt = _write(tmp_path / "data.txt", "a\n1\n")
    with pytest.raises(ValueError):
        csv_to_parquet(spark, txt)
    assert csv_to_parquet(spark, txt, compat=True) is None


def test_quarantine_splits_bad_rows(spark, tmp_path):
    text = GOOD + "a3,not a date,2\na4,2022-04-24,x\na5,2022-04-25\n"
    res = csv_quarantine(spark, _write(tmp_path / "crash.csv", text), SCHEMA)
    good = {r.CRASH_RECORD_ID: r for r in spark.read.parquet(res.target).collect()}
    bad = {r.CRASH_RECORD_ID: r.reason for r in spark.read.parquet(res.quarantine).collect()}
    assert set(good) == {"a1", "a2"}
    assert good["a1"].CRASH_DATE == dt.datetime(2022, 4, 22, 22, 30)
    assert bad["a3"] == "unparsable date"
    assert bad["a4"] == "malformed row" and bad["a5"] == "malformed row"


def test_ingest_datasets_lands_each_name(spark, tmp_path):
    src = _write(tmp_path / "crash.csv", GOOD)
    res = ingest_datasets(spark, {"crash": src}, str(tmp_path / "raw"), {"crash": SCHEMA})
    assert spark.read.parquet(res["crash"].target).count() == 2


def test_blank_headers_are_sanitized(spark, tmp_path):
    src = _write(tmp_path / "h.csv", "CRASH RECORD ID,INJURIES TOTAL\na1,1\n")
    df = sanitize_columns(read_csv_table(spark, src))
    assert df.columns == ["CRASH_RECORD_ID", "INJURIES_TOTAL"]


def test_read_with_schema_resolves_by_name(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("a", 1)], "A string, B bigint").write.parquet(path)
    other = spark.createDataFrame([], "A string, C bigint")
    rows = read_with_schema(spark, path, other).collect()
    assert rows[0].A == "a" and rows[0].C is None


def test_sink_modes_and_stage(spark, tmp_path):
    df = spark.range(5)
    path = str(tmp_path / "out")
    write_parquet(df, path)
    write_parquet(df, path)  # overwrite is idempotent
    with pytest.raises(Exception):
        write_parquet(df, path, mode="errorifexists")
    staged = stage_parquet(df.filter("id > 1"))
    assert staged.count() == 3
    assert os.path.isdir(os.path.join(str(tmp_path), "out"))


def test_catalog_tables(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_parquet(spark.createDataFrame([("a", 2022), ("b", 2023)], "id string, CRASH_YEAR int"), path)
    ext = register_external(spark, "years_ext", path)
    assert ext.count() == 2 and register_external(spark, "years_ext", path).count() == 2
    out = publish_table(spark, "years_ext", "years", partition_by=["CRASH_YEAR"])
    again = publish_table(spark, "years_ext", "years", partition_by=["CRASH_YEAR"])
    assert out.count() == again.count() == 2
    with pytest.raises(Exception):
        write_table(spark.table("years"), "years")
    with pytest.raises(ValueError, match="only an external"):
        register_external(spark, "years", path)  # never drops a published table and its data
    with pytest.raises(ValueError, match="external"):
        publish_table(spark, "years", "years_ext")
    broken = spark.createDataFrame([("x",)], "id string").selectExpr("raise_error(id) AS id")
    with pytest.raises(Exception, match="x"):
        publish_table(spark, broken, "years")
    assert spark.table("years").count() == 2  # a failed write leaves the old table
    assert publish_table(spark, spark.table("years_ext").limit(1), "years").count() == 1


def test_external_table_over_a_partitioned_folder(spark, tmp_path):
    path = str(tmp_path / "years")
    rows = [("a", 2021), ("b", 2022), ("c", None)]
    write_parquet(spark.createDataFrame(rows, "id string, CRASH_YEAR int"), path, partition_by=["CRASH_YEAR"])
    table = register_external(spark, "ext_by_year", path)
    assert sorted(map(tuple, table.collect()), key=str) == sorted(rows, key=str)
    assert [r.id for r in table.filter("CRASH_YEAR = 2022").collect()] == ["b"]
    write_parquet(spark.createDataFrame([("d", 2023)], "id string, CRASH_YEAR int"), path, mode="append", partition_by=["CRASH_YEAR"])
    assert register_external(spark, "ext_by_year", path).count() == 4  # the new folder is listed


def test_partitioned_overwrite_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "by_year")
    both = spark.createDataFrame([("a", 2021), ("b", 2022)], "id string, y int")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_parquet(both, path, partition_by=["y"])
        write_parquet(both.filter("y = 2022"), path, partition_by=["y"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.id for r in spark.read.parquet(path).collect()] == ["b"]


WIDE = "CRASH_RECORD_ID,X,CRASH_DATE,INJURIES_TOTAL\na1,x,2022-04-22,1\n"


@pytest.mark.parametrize("row", ["a2,x,2022-04-22,1,5,6", "a2,x", "a2"])
def test_ragged_rows_with_undeclared_columns(spark, tmp_path, row):
    src = _write(tmp_path / "wide.csv", WIDE + row + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        csv_to_parquet(spark, src, schema=SCHEMA)
    res = csv_quarantine(spark, src, SCHEMA)
    assert (res.rows, res.rejected) == (1, 1)
    assert [r.CRASH_RECORD_ID for r in spark.read.parquet(res.target).collect()] == ["a1"]
    with pytest.raises(TooManyRejectedError):
        csv_quarantine(spark, src, SCHEMA, max_rejected=0)


def test_files_with_other_headers_fail(spark, tmp_path):
    folder = tmp_path / "two.csv"
    folder.mkdir()
    _write(folder / "a.csv", "A,B\n1,2\n")
    _write(folder / "b.csv", "B,A\n3,4\n")
    schema = T.StructType([T.StructField("A", T.LongType()), T.StructField("B", T.LongType())])
    with pytest.raises(Exception):
        csv_to_parquet(spark, str(folder), schema=schema)


def test_compat_landing_keeps_empty_text_and_rows_without_a_date(spark, tmp_path):
    src = _write(tmp_path / "c.csv", GOOD + ',2022-04-22,\na9,yesterday,3\n')
    rows = spark.read.parquet(csv_to_parquet(spark, src, schema=SCHEMA, compat=True)).collect()
    assert ("", None) in {(r.CRASH_RECORD_ID, r.INJURIES_TOTAL) for r in rows}
    assert {r.CRASH_RECORD_ID: r.CRASH_DATE for r in rows}["a9"] is None and len(rows) == 4


def test_output_contract(spark):
    df = spark.createDataFrame([("a", "7")], "x string, y string")
    out = apply_output_contract(df, [("Y", "bigint"), ("X", "string")])
    assert out.columns == ["Y", "X"] and out.first().Y == 7
    with pytest.raises(ValueError):
        apply_output_contract(df, [("x", "string")])
    with pytest.raises(ValueError):
        apply_output_contract(df, [("z", "string")], allow_extra=True)
    assert len(CRASH_SUMMARY_CONTRACT) == 48


def test_assert_unique_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    with pytest.raises(ValueError, match="not unique"):
        assert_unique_key(df, ["k"])
    assert_unique_key(df.distinct(), ["k", "v"])  # unique: no error


def test_run_pipeline_end_to_end(spark, tmp_path):
    """CSV drops in the open-data date layout -> raw -> job A -> clean -> published table,
    equal to the job run directly on the source tables."""
    from conftest import SF_SMOKE
    from wreckline.plans import crash_summary, run_pipeline
    from wreckline.sources import crash_tables

    c, v, p = crash_tables(spark, SF_SMOKE)
    csvs = {}
    for name, df in (("crash", c), ("vehicles", v), ("people", p)):
        path = str(tmp_path / f"{name}.csv")
        # keep ' ' values as they are (the writer trims them by default)
        (df.write.option("header", True).option("timestampNTZFormat", "MM/dd/yyyy hh:mm:ss a")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        csvs[name] = path
    names = {name: f"raw_{name}_e2e" for name in csvs}
    res = run_pipeline(spark, csvs, str(tmp_path / "zones"), table="summary_e2e", external_table="summary_ext_e2e",
                       raw_tables=names)
    for name, df in (("crash", c), ("vehicles", v), ("people", p)):
        assert (res.landed[name].rows, res.landed[name].rejected) == (df.count(), 0)
        assert spark.table(names[name]).count() == df.count()
    assert spark.table("summary_ext_e2e").count() == spark.table("summary_e2e").count()
    got = spark.table("summary_e2e")
    want = crash_summary(c, v, p)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert res.clean.endswith("clean/crash_summary")
    # A rerun goes on where the earlier one stopped: finished zones are kept as they are.
    stamp = os.path.getmtime(f"{tmp_path}/zones/raw/crash/_SUCCESS")
    done = os.path.getmtime(f"{res.clean}/_SUCCESS")
    os.remove(f"{tmp_path}/zones/raw/people/_SUCCESS")
    again = run_pipeline(spark, csvs, str(tmp_path / "zones"), table="summary_e2e_only", resume=True)
    assert os.path.getmtime(f"{tmp_path}/zones/raw/crash/_SUCCESS") == stamp
    assert os.path.exists(f"{tmp_path}/zones/raw/people/_SUCCESS") and os.path.getmtime(f"{res.clean}/_SUCCESS") == done
    assert again.external_table is None and spark.table("summary_e2e_only").count() == want.count()
    # A', published without an external table in between
    run_pipeline(spark, csvs, str(tmp_path / "zones"), job="crash_vehicle_summary", table="units_e2e", resume=True)
    assert len(spark.table("units_e2e").columns) == 31 and spark.table("units_e2e").count() > 0


def test_strict_ingest_parses_export_dates_and_rejects_junk(spark, tmp_path):
    out = csv_to_parquet(spark, _write(tmp_path / "ok.csv", GOOD), schema=SCHEMA)
    dates = sorted(r.CRASH_DATE for r in spark.read.parquet(out).collect())
    assert dates == [dt.datetime(2022, 4, 22, 22, 30), dt.datetime(2022, 4, 23, 8, 0)]
    junk = _write(tmp_path / "junk.csv", GOOD + "a3,yesterday,1\n")
    with pytest.raises(Exception, match="unparsable CRASH_DATE"):
        csv_to_parquet(spark, junk, schema=SCHEMA)


def test_transform_job_entry_point(spark, tmp_path):
    """jobs/transform.py with the studied jobs' four arguments."""
    import importlib.util

    from conftest import ROOT, SF_SMOKE
    from wreckline.sources import crash_tables

    c, v, p = crash_tables(spark, SF_SMOKE)
    paths = {}
    for name, df in (("crash", c), ("vehicles", v), ("people", p)):
        paths[name] = write_parquet(df, str(tmp_path / "raw" / name))
    spec = importlib.util.spec_from_file_location("transform_job", os.path.join(ROOT, "jobs", "transform.py"))
    job = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(job)
    for which, cols in (("crash_summary", 48), ("crash_vehicle_summary", 31), ("vehicle_person_detail", 19)):
        out = job.main([
            "--input_crashes", paths["crash"], "--input_vehicles", paths["vehicles"],
            "--input_people", paths["people"], "--output", str(tmp_path / which), "--job", which,
        ])
        assert len(spark.read.parquet(out).columns) == cols


def test_changed_source_files_land_anew(spark, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from conftest import SF_SMOKE
    from wreckline.sources.derived import landed_crash_tables

    for name in ("orders", "lineitem", "part"):
        shutil.copyfile(f"{SF_SMOKE}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = landed_crash_tables(spark, str(tmp_path))[0].count()
    some = pq.read_table(f"{SF_SMOKE}/orders.parquet").slice(0, 10)
    pq.write_table(some, tmp_path / "orders.parquet")
    assert before > 10 and landed_crash_tables(spark, str(tmp_path))[0].count() == 10


def test_resume_lands_changed_sources_only(spark, tmp_path):
    from pyspark.sql import types as T

    from wreckline.sources.ingest import ingest_datasets

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    for name, n in (("x", 3), ("y", 5)):
        (tmp_path / f"{name}.csv").write_text("a,b\n" + "".join(f"{i},v{i}\n" for i in range(n)))
    sources, root = {n: f"{tmp_path}/{n}.csv" for n in "xy"}, f"{tmp_path}/raw"
    land = lambda **more: ingest_datasets(spark, sources, root, {"x": schema, "y": schema}, **more)
    files = lambda n: {p.name for p in (tmp_path / "raw" / n).glob("part-*")}
    assert {k: r.rows for k, r in land().items()} == {"x": 3, "y": 5}
    before = files("x"), files("y")
    (tmp_path / "y.csv").write_text("a,b\n7,new\n")
    assert {k: r.rows for k, r in land(resume=True).items()} == {"x": 3, "y": 1}
    assert files("x") == before[0] and files("y") != before[1]  # kept, and landed anew
    kept = files("y")
    land(resume=True)
    assert files("y") == kept
    land(resume=True, quarantine=True)  # other settings
    assert files("y") != kept


def test_a_failed_dataset_leaves_the_others_landed(spark, tmp_path):
    from pyspark.sql import types as T

    from wreckline.sources.ingest import EmptyCsvError, ingest_datasets

    schema = T.StructType([T.StructField("a", T.LongType())])
    (tmp_path / "good.csv").write_text("a\n1\n2\n")
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(EmptyCsvError) as raised:
        ingest_datasets(spark, {"empty": f"{tmp_path}/empty.csv", "good": f"{tmp_path}/good.csv"}, f"{tmp_path}/raw",
                        {"empty": schema, "good": schema})
    assert any("good: landed, 2 rows" in note for note in raised.value.__notes__)
    assert spark.read.parquet(f"{tmp_path}/raw/good").count() == 2


def test_a_reader_always_finds_a_published_table(spark, monkeypatch):
    """Between any two catalog commands of a publish the name shows the old or the new rows,
    with other columns and partitions, too; a failed switch leaves the old ones."""
    from wreckline.sources import sinks

    name = "switched"
    publish_table(spark, spark.range(3), name)
    wider = spark.range(5).selectExpr("id", "id % 2 AS odd")
    told, seen = spark.sql, []

    class Watching:
        """The session, which reads the published name after each command."""

        def __init__(self, fail_at=None):
            self.fail_at = fail_at

        def __getattr__(self, attribute):
            return getattr(spark, attribute)

        def sql(self, text):
            if self.fail_at and text.startswith(self.fail_at):
                raise RuntimeError("catalog is away")
            out = told(text)
            seen.append(spark.table(name).count())
            return out

    with pytest.raises(RuntimeError, match="away"):
        publish_table(Watching("ALTER VIEW"), wider, name)
    assert spark.table(name).columns == ["id"] and set(seen) == {3}
    publish_table(Watching(), wider, name, partition_by=["odd"])
    assert spark.table(name).columns == ["id", "odd"] and set(seen) == {3, 5}
    begun = spark.table(name)
    publish_table(spark, spark.range(7), name)
    assert begun.count() == 5 and spark.table(name).count() == 7  # a reader ends on the version it began on
    assert len(sinks._versions(spark, name)) == 2
    spark.sql("CREATE VIEW of_another AS SELECT 1 AS one")
    with pytest.raises(ValueError, match="view"):
        publish_table(spark, spark.range(1), "of_another")
    sinks.unpublish_table(spark, name)
    assert not spark.catalog.tableExists(name) and not sinks._versions(spark, name)


def test_filters_prune_partitions_through_the_published_name(spark):
    out = publish_table(spark, spark.range(40).selectExpr("id", "id % 4 AS part"), "pruned", partition_by=["part"])
    plan = out.filter("part = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and out.filter("part = 3").count() == 10


def test_quarantine_counts_while_it_lands(spark, tmp_path, monkeypatch):
    """A clean source is parsed by one write; rejects cost one scan more. Nothing is counted anew."""
    from wreckline.sources import ingest

    written = []

    def writing(df, path, **more):
        written.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        return write_parquet(df, path, **more)

    monkeypatch.setattr(ingest, "write_parquet", writing)
    clean = csv_quarantine(spark, _write(tmp_path / "clean.csv", GOOD), SCHEMA)
    assert (clean.rows, clean.rejected) == (2, 0) and written == [1, 0]
    bad = csv_quarantine(spark, _write(tmp_path / "bad.csv", GOOD + "a3,not a date,2\na4\n"), SCHEMA)
    assert (bad.rows, bad.rejected) == (2, 2) and written[2:] == [1, 1]
    assert spark.read.parquet(bad.target).count() == 2 == spark.read.parquet(bad.quarantine).count()
    assert spark.read.parquet(clean.quarantine).columns == spark.read.parquet(bad.quarantine).columns


def _shuffle_files(spark) -> set[str]:
    import glob

    return set(glob.glob(f"{spark.sparkContext.getConf().get('spark.local.dir')}/**/shuffle_*", recursive=True))


def test_shuffles_go_with_the_write(spark, tmp_path):
    import time

    from pyspark.sql import functions as F

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before, before = spark.conf.get(setting), _shuffle_files(spark)
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()
    assert _shuffle_files(spark) - before  # as Spark leaves them
    before = _shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").count()
    assert stage_parquet(rows, str(tmp_path / "staged")).count() == 7
    write_table(rows, "shuffles_go", mode="overwrite")
    spark.sql("DROP TABLE shuffles_go")
    kept = spark.read.parquet(write_parquet(rows.repartition(3), str(tmp_path / "zone")))
    assert kept.count() == 7 and spark.conf.get(setting) == set_before
    end = time.time() + 20
    # The counts above leave their own: one row each.
    written = lambda: [f for f in _shuffle_files(spark) - before if os.path.exists(f) and os.path.getsize(f) > 200]
    while written() and time.time() < end:
        time.sleep(0.2)
    assert not written()


def test_writes_at_once_share_the_setting(spark):
    from wreckline.session import freed_shuffles

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(setting, "false")
    try:
        one, other = freed_shuffles(spark), freed_shuffles(spark)
        one.__enter__()
        other.__enter__()
        one.__exit__(None, None, None)
        assert spark.conf.get(setting) == "true"
        other.__exit__(None, None, None)
        assert spark.conf.get(setting) == "false"
    finally:
        spark.conf.unset(setting)


def test_drops_need_no_landed_zone(spark, tmp_path):
    import shutil

    from conftest import SF_SMOKE
    from wreckline.sources import derived

    for name in ("orders", "lineitem", "part"):
        shutil.copy(f"{SF_SMOKE}/{name}.parquet", tmp_path)
    csvs = derived.exported_csv(spark, str(tmp_path))
    assert derived._key(spark, str(tmp_path)) not in derived._LANDED
    for name, df in zip(("crash", "vehicles", "people"), derived.crash_tables(spark, str(tmp_path)), strict=True):
        assert spark.read.option("header", True).csv(csvs[name]).count() == df.count()
