"""Named queries over the test tables: name -> (spark, sf_dir) -> DataFrame.

Each query derives the crash, unit and person tables from the given ``orders``,
``lineitem`` and ``part`` tables (landed once per session as a raw Parquet zone, as the
studied pipeline does) and runs one operator or pipeline over all of them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wreckline.oracle import LOOKUP_CRASH_ID
from wreckline.operators import (
    dedup_rows,
    duplicate_keys,
    filter_drivers,
    multi_vehicle_crashes,
    number_units,
    people_summary,
    person_slots,
    preview,
    sanitize_columns,
    vehicle_pivot,
    vehicle_slots,
    vehicle_summary,
    vehicles_of_crash,
)
from wreckline.plans import (
    clean_make_model,
    crash_calendar,
    crash_summary,
    crash_vehicle_summary,
    street_labels,
    vehicle_person_detail,
)
from wreckline.plans.publish import RunResult, run_pipeline, transform
from wreckline.schemas import PEOPLE_COLUMNS_WITH_VEHICLE
from wreckline.schemas import SCHEMAS
from wreckline.session import shared_dir
from wreckline.sources.derived import exported_csv, landed_crash_tables, landed_root
from wreckline.sources.hot_list import load_hot_keys
from wreckline.sources.ingest import EmptyCsvError, csv_quarantine, csv_to_parquet, header_columns
from wreckline.sources.readers import read_with_schema
from wreckline.sources.sinks import publish_table, register_external, stage_parquet, write_parquet

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        crashes, vehicles, people = landed_crash_tables(spark, sf_dir)
        return fn(crashes, vehicles, people)

    run.__doc__ = fn.__doc__
    return run


def _routed(fn: Callable[..., DataFrame], tables: str = "cvp") -> Query:
    """A query that routes by the list of hot crash ids kept with the raw zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = dict(zip("cvp", landed_crash_tables(spark, sf_dir), strict=True))
        return fn(*[frames[t] for t in tables], hot=load_hot_keys(spark, landed_root(spark, sf_dir)))

    return run


def _ingest(name: str, quarantine: bool) -> Query:
    """Land one CSV drop of the derived tables through the ingest path and read it back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = exported_csv(spark, sf_dir)[name]
        target = shared_dir(spark, f"landed-{name}")
        if quarantine:
            target = csv_quarantine(spark, src, SCHEMAS[name], dst=target).target
        else:
            target = csv_to_parquet(spark, src, target, schema=SCHEMAS[name])
        return spark.read.parquet(target)

    return run


def _repeated(people: DataFrame) -> DataFrame:
    """People of whom every 11th occurs again with another sex and with another RD_NO, and
    every 22nd once more as it is."""
    again = people.filter("VEHICLE_ID % 11 = 0")
    return (people.unionByName(again.withColumn("SEX", F.lit("X"))).unionByName(again.withColumn("RD_NO", F.lit("RD0")))
            .unionByName(people.filter("VEHICLE_ID % 22 = 0")))


def _scratch_name(spark: SparkSession, name: str) -> str:
    """A table name of its own, in a database whose files go with the session's folder."""
    database = re.sub(r"\W", "_", f"wreckline_{spark.sparkContext.applicationId}")
    if not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_dir(spark, 'tables')}'")
    return f"{database}.{name}_{uuid.uuid4().hex[:8]}"


def _run(job: str, read: Callable[[SparkSession, RunResult], DataFrame]) -> Query:
    """The whole run over CSV drops, into tables of its own; what ``read`` reads back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        done = run_pipeline(
            spark, exported_csv(spark, sf_dir), shared_dir(spark, "run"), job=job,
            external_table=_scratch_name(spark, f"clean_{job}"), table=_scratch_name(spark, f"published_{job}"),
            raw_tables={name: _scratch_name(spark, f"raw_{name}") for name in SCHEMAS})
        return read(spark, done)

    return run


def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, and a second one that resumes it: the zones are kept, the result is the same."""
    root, csvs = shared_dir(spark, "resumed"), exported_csv(spark, sf_dir)
    first = run_pipeline(spark, csvs, root, job="crash_vehicle_summary")
    again = run_pipeline(spark, csvs, root, job="crash_vehicle_summary", resume=True)
    assert again.clean == first.clean
    return spark.read.parquet(again.clean)


def _raw_counts(spark: SparkSession, done: RunResult) -> DataFrame:
    out = None
    for name, table in done.raw_tables.items():
        one = spark.table(table).agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.countDistinct("CRASH_RECORD_ID").alias("crash_ids"))
        out = one if out is None else out.unionByName(one)
    return out


def _partitioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A' published as a managed table partitioned by hour, twice: the second replaces."""
    crashes, vehicles, _ = landed_crash_tables(spark, sf_dir)
    name = _scratch_name(spark, "by_hour")
    publish_table(spark, crash_vehicle_summary(crashes, vehicles).limit(1), name, partition_by=["HOUR_OF_DAY"])
    return publish_table(spark, crash_vehicle_summary(crashes, vehicles), name, partition_by=["HOUR_OF_DAY"])


def _external_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A' written by hour and read through an external table over the folder."""
    crashes, vehicles, _ = landed_crash_tables(spark, sf_dir)
    zone = write_parquet(crash_vehicle_summary(crashes, vehicles), shared_dir(spark, "by-hour"), partition_by=["HOUR_OF_DAY"])
    return register_external(spark, _scratch_name(spark, "external_by_hour"), zone)


def _schema_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The people zone read with a declared schema that has a column the files lack."""
    _, _, people = landed_crash_tables(spark, sf_dir)
    zone = write_parquet(people, shared_dir(spark, "people"))
    return read_with_schema(spark, zone, SCHEMAS["people"])


def _ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop with a column that is not declared, in which every 7th row is ragged: what
    landed and what was set aside."""
    crashes, _, _ = landed_crash_tables(spark, sf_dir)
    declared = T.StructType([f for f in SCHEMAS["crash"].fields if f.name in ("CRASH_RECORD_ID", "RD_NO", "INJURIES_TOTAL")])
    key = F.col("CRASH_RECORD_ID").cast("bigint")
    rows = crashes.select(F.concat_ws(
        ",", F.col("CRASH_RECORD_ID"), F.coalesce("RD_NO", F.lit("")), F.lit("x"),
        F.when(key % 14 == 0, F.lit("1,2,3")).when(key % 7 != 0, F.coalesce(F.col("INJURIES_TOTAL").cast("string"), F.lit("")))
    ).alias("value"))
    # One file per part, each with its header, as extracts come: the text writer puts the
    # column's name, here the header line, first.
    src = f"{shared_dir(spark, 'ragged')}/crash.csv"
    rows.toDF("CRASH_RECORD_ID,RD_NO,UNDECLARED,INJURIES_TOTAL").write.option("header", True).option("sep", "\u0001").option(
        "quote", "\u0000").option("emptyValue", "").csv(src)
    done = csv_quarantine(spark, src, declared, dst=shared_dir(spark, "landed"), quarantine=shared_dir(spark, "rejected"))
    counted = F.col("INJURIES_TOTAL").isNotNull()
    good = spark.read.parquet(done.target).select("CRASH_RECORD_ID", "RD_NO", counted.alias("counted"), F.lit("landed").alias("fate"))
    bad = spark.read.parquet(done.quarantine).select(
        "CRASH_RECORD_ID", "RD_NO", F.lit(False).alias("counted"), F.lit("rejected").alias("fate"))
    return good.unionByName(bad)


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops: one that lands, the same rows under another name ending, and one without a
    line. The first lands, the second is skipped (compat) or refused, the last is refused."""
    src = exported_csv(spark, sf_dir)["crash"]
    root = shared_dir(spark, "drops")
    other, empty = f"{root}/crash.txt", f"{root}/empty.csv"
    spark.read.text(src).write.text(other)
    spark.createDataFrame([], "value string").write.text(empty)
    fates = []
    for drop, path in (("crash", src), ("other name", other), ("no line", empty)):
        for compat in (False, True):
            try:
                done = csv_to_parquet(spark, path, shared_dir(spark, "guarded"), schema=SCHEMAS["crash"], compat=compat)
                fate = "skipped" if done is None else "landed"
            except EmptyCsvError:
                done, fate = None, "empty"
            except ValueError:
                done, fate = None, "refused"
            landed = spark.read.parquet(done) if done else spark.createDataFrame([], "CRASH_RECORD_ID string")
            fates.append(landed.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(drop).alias("drop_name"), F.lit(compat).alias("compat"), F.lit(fate).alias("fate"), "n"))
    return reduce(DataFrame.unionByName, fates)


def _compat_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crash drop landed as the studied pipeline lands it: empty text stays empty text."""
    target = csv_to_parquet(
        spark, exported_csv(spark, sf_dir)["crash"], shared_dir(spark, "compat"), schema=SCHEMAS["crash"], compat=True)
    return spark.read.parquet(target)


def _frame_schema_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit zone read with the schema of the crash frame: what both name is read, the rest is NULL."""
    crashes, _, _ = landed_crash_tables(spark, sf_dir)
    return read_with_schema(spark, f"{landed_root(spark, sf_dir)}/vehicles", crashes)


def _kept_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that must not overwrite: the second write fails, what the first wrote is read back."""
    crashes, vehicles, _ = landed_crash_tables(spark, sf_dir)
    path = write_parquet(crashes, shared_dir(spark, "kept"), mode="errorifexists")
    try:
        write_parquet(vehicles, path, mode="errorifexists")
    except AnalysisException as refused:
        if "PATH_ALREADY_EXISTS" not in str(refused):
            raise
    else:
        raise AssertionError(f"{path} was written twice")
    return spark.read.parquet(path)


def _transform_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch transform by its four arguments (three inputs, one output), read back."""
    root = landed_root(spark, sf_dir)
    out = transform(spark, f"{root}/crash", f"{root}/vehicles", f"{root}/people", job="vehicle_person_detail",
                    hot=load_hot_keys(spark, root))
    return spark.read.parquet(write_parquet(out, shared_dir(spark, "job-output")))


def _resumed_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over two thirds of the unit drop, then a resumed one after the drop was replaced:
    the units and what is made of them are written anew, the other zones are kept."""
    csvs, root = dict(exported_csv(spark, sf_dir)), shared_dir(spark, "changed")
    whole = spark.read.text(csvs["vehicles"])
    csvs["vehicles"] = f"{root}-vehicles.csv"
    header = header_columns(spark, exported_csv(spark, sf_dir)["vehicles"])
    lines = whole.filter(F.col("value") != ",".join(header)).toDF(",".join(header))

    def drop(rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("header", True).option("sep", "\u0001").option("quote", "\u0000").option(
            "emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option(
            "compression", "gzip").csv(csvs["vehicles"])

    drop(lines.filter(F.crc32(F.col(f"`{lines.columns[0]}`")) % 3 != 0))
    run_pipeline(spark, csvs, root, job="crash_vehicle_summary")
    drop(lines)
    done = run_pipeline(spark, csvs, root, job="crash_vehicle_summary", resume=True)
    return spark.read.parquet(done.clean)


QUERIES: dict[str, Query] = {
    # sources: CSV drops landed strictly (FAILFAST) or with a quarantine
    "ingest_crashes_csv": _ingest("crash", quarantine=False),
    "ingest_vehicles_csv": _ingest("vehicles", quarantine=True),
    "ingest_people_csv": _ingest("people", quarantine=True),
    "ingest_crashes_compat": _compat_landing,
    "guarded_drops": _guarded,
    # pipelines
    "vehicle_person_detail": _routed(vehicle_person_detail),
    "vehicle_person_detail_fixed": _routed(partial(vehicle_person_detail, compat=False)),
    # crashes with 10+ units keep their rows spread (broadcast crash attributes)
    "vehicle_person_detail_mixed": _q(lambda c, v, p: vehicle_person_detail(c, v, p, hot_rows=10)),
    "crash_summary": _routed(crash_summary),
    "crash_summary_fixed": _routed(partial(crash_summary, compat=False)),
    # crashes with 5+ rows in any table take the skew-proof plans, the others the plain ones
    "crash_summary_mixed": _q(lambda c, v, p: crash_summary(c, v, p, hot_rows=5)),
    "crash_vehicle_summary": _routed(crash_vehicle_summary, "cv"),
    "crash_vehicle_summary_fixed": _routed(partial(crash_vehicle_summary, compat=False), "cv"),
    # unit summaries and slots
    "vehicle_summary": _routed(vehicle_summary, "v"),
    "vehicle_summary_join": _q(lambda c, v, p: vehicle_summary(v, compat=True, strategy="lookup")),
    "vehicle_summary_window": _q(lambda c, v, p: vehicle_summary(v, compat=True, strategy="window")),
    "vehicle_summary_topk": _q(lambda c, v, p: vehicle_summary(v, compat=True, strategy="topk")),
    # crashes with 10+ units take the skew-proof plan, the others the window plan
    "vehicle_summary_mixed": _q(lambda c, v, p: vehicle_summary(v, compat=True, hot_rows=10)),
    "vehicle_summary_fixed": _routed(partial(vehicle_summary, compat=False), "v"),
    "vehicle_summary_fixed_topk": _q(lambda c, v, p: vehicle_summary(v, compat=False, strategy="topk")),
    "vehicle_slots": _routed(vehicle_slots, "v"),
    "vehicle_slots_topk": _q(lambda c, v, p: vehicle_slots(v, strategy="topk")),
    "vehicle_pivot": _routed(vehicle_pivot, "v"),
    "vehicle_pivot_topk": _q(lambda c, v, p: vehicle_pivot(v, strategy="topk")),
    # driver summaries and slots
    "people_summary": _routed(people_summary, "p"),
    "people_summary_fixed": _routed(partial(people_summary, compat=False), "p"),
    "people_summary_partial": _q(lambda c, v, p: people_summary(p, compat=True, strategy="partial")),
    "people_summary_fixed_topk": _q(lambda c, v, p: people_summary(p, compat=False, strategy="partial")),
    "person_slots": _q(lambda c, v, p: person_slots(p)),
    "people_summary_repeated": _q(lambda c, v, p: people_summary(_repeated(p))),
    "people_summary_repeated_partial": _q(lambda c, v, p: people_summary(_repeated(p), strategy="partial")),
    # combinations with their number of occurrences: expanded, four copies are 1,024 rows
    "person_slots_repeated": _q(lambda c, v, p: person_slots(_repeated(p), expand=False)),
    # expanded: every 11th person occurs twice, so their drivers make 32 rows each
    "person_slots_repeated_expanded": _q(
        lambda c, v, p: person_slots(p.unionByName(p.filter("VEHICLE_ID % 11 = 0").withColumn("SEX", F.lit("X"))))),
    "duplicate_person_keys_found": _q(
        lambda c, v, p: duplicate_keys(_repeated(p), ["CRASH_RECORD_ID", "CRASH_DATE", "PERSON_ID"])),
    # sinks, catalog, stages and whole runs, read back
    "run_published_summary": _run("crash_summary", lambda spark, done: spark.table(done.table)),
    "run_published_units": _run("crash_vehicle_summary", lambda spark, done: spark.table(done.external_table)),
    "run_resumed": _resumed,
    "run_resumed_after_change": _resumed_after_change,
    "transform_job": _transform_job,
    "sink_kept": _kept_sink,
    "raw_tables_of_run": _run("crash_vehicle_summary", _raw_counts),
    "staged_detail": _q(lambda c, v, p: stage_parquet(vehicle_person_detail(c, v, p))),
    "partitioned_publish": _partitioned_publish,
    "external_by_hour": _external_by_hour,
    "schema_read": _schema_read,
    "frame_schema_read": _frame_schema_read,
    "renamed_columns": _q(lambda c, v, p: sanitize_columns(c.toDF(*[x.replace("_", " ") for x in c.columns]))),
    "ragged_rows_rejected": _ragged,
    # numbering, look-ups, grouping
    "number_units": _routed(number_units, "v"),
    # crashes with 10+ units numbered across range blocks, the others by one window
    "number_units_mixed": _q(lambda c, v, p: number_units(v, hot_rows=10)),
    "number_units_ranged": _q(lambda c, v, p: number_units(v, skew_safe=True)),
    "vehicles_of_crash": _q(lambda c, v, p: vehicles_of_crash(v, LOOKUP_CRASH_ID)),
    "multi_vehicle_crashes": _q(lambda c, v, p: multi_vehicle_crashes(v)),
    "filter_drivers": _q(lambda c, v, p: filter_drivers(p).select(*PEOPLE_COLUMNS_WITH_VEHICLE)),
    "duplicate_person_keys": _q(lambda c, v, p: duplicate_keys(p, ["CRASH_RECORD_ID", "CRASH_DATE", "PERSON_ID"])),
    "dedup_units": _q(
        lambda c, v, p: dedup_rows(v.select("CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", "UNIT_TYPE", "MAKE", "MODEL"))
    ),
    "preview_crashes": _q(lambda c, v, p: preview(c, 20, ["CRASH_RECORD_ID"])),
    # scalar functions as stand-alone queries
    "crash_calendar": _q(lambda c, v, p: crash_calendar(c, compat=True)),
    "crash_calendar_fixed": _q(lambda c, v, p: crash_calendar(c, compat=False)),
    "street_label": _q(lambda c, v, p: street_labels(c, compat=True)),
    "street_label_fixed": _q(lambda c, v, p: street_labels(c, compat=False)),
    "clean_make_model": _q(lambda c, v, p: clean_make_model(v, compat=True)),
    "clean_make_model_fixed": _q(lambda c, v, p: clean_make_model(v, compat=False)),
}
