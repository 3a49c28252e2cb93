"""A crash holding a third of all units and people: routed (skew-proof) plans must give
exactly what the plain plans and the self-join SQL give."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE  # noqa: E402
from oracle_check import rows_of_duckdb, rows_of_spark  # noqa: E402
from wreckline.operators import number_units, people_summary, vehicle_pivot, vehicle_slots, vehicle_summary
from wreckline.operators.skew import hot_keys
from wreckline.oracle import oracle_queries_over_views
from wreckline.plans import crash_summary, vehicle_person_detail
from wreckline.sources import crash_tables

HOT_DATE = dt.datetime(2022, 4, 22, 22, 30)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    c, v, p = crash_tables(spark, SF_SMOKE)

    hot_keys_values = {
        "CRASH_RECORD_ID": F.lit("HOT"),
        "RD_NO": F.lit("RDHOT"),
        "CRASH_DATE": F.lit(HOT_DATE).cast("timestamp_ntz"),
    }

    def fold(df):
        """Every row of every third crash moves into the one crash 'HOT'."""
        to_hot = F.col("CRASH_RECORD_ID").cast("bigint") % 3 == 0
        return df.select(*[
            F.when(to_hot, hot_keys_values[col]).otherwise(F.col(col)).alias(col)
            if col in hot_keys_values else F.col(col)
            for col in df.columns
        ])

    hot_crash = c.limit(1).select(
        F.lit("HOT").alias("CRASH_RECORD_ID"), F.lit("RDHOT").alias("RD_NO"),
        F.lit(HOT_DATE).cast("timestamp_ntz").alias("CRASH_DATE"),
        *[F.col(x) for x in c.columns if x not in ("CRASH_RECORD_ID", "RD_NO", "CRASH_DATE")],
    )
    base = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    out = {}
    for name, df in (("crashes", c.unionByName(hot_crash)), ("vehicles", fold(v)), ("people", fold(p))):
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        out[name] = spark.read.parquet(f"{base}/{name}")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{base}/{name}/*.parquet')")
    return out["crashes"], out["vehicles"], out["people"], con


HOT_ROWS = 500
SQL = oracle_queries_over_views()
CASES = {
    "vehicle_summary": (lambda c, v, p: vehicle_summary(v, hot_rows=HOT_ROWS),
                        lambda c, v, p: vehicle_summary(v, strategy="window")),
    "vehicle_summary_fixed": (lambda c, v, p: vehicle_summary(v, compat=False, hot_rows=HOT_ROWS),
                              lambda c, v, p: vehicle_summary(v, compat=False, strategy="window")),
    "vehicle_pivot": (lambda c, v, p: vehicle_pivot(v, hot_rows=HOT_ROWS),
                      lambda c, v, p: vehicle_pivot(v, strategy="window")),
    "vehicle_slots": (lambda c, v, p: vehicle_slots(v, hot_rows=HOT_ROWS),
                      lambda c, v, p: vehicle_slots(v, strategy="window")),
    "people_summary": (lambda c, v, p: people_summary(p, hot_rows=HOT_ROWS),
                       lambda c, v, p: people_summary(p, strategy="cluster")),
    "people_summary_fixed": (lambda c, v, p: people_summary(p, compat=False, hot_rows=HOT_ROWS),
                             lambda c, v, p: people_summary(p, compat=False, strategy="cluster")),
    "number_units": (lambda c, v, p: number_units(v, hot_rows=HOT_ROWS),
                     lambda c, v, p: number_units(v, skew_safe=False)),
    "vehicle_person_detail": (lambda c, v, p: vehicle_person_detail(c, v, p, hot_rows=HOT_ROWS),
                              lambda c, v, p: vehicle_person_detail(c, v, p, strategy="shuffle")),
    "crash_summary": (lambda c, v, p: crash_summary(c, v, p, strategy="topk"),
                      lambda c, v, p: crash_summary(c, v, p, strategy="window")),
}


def test_hot_crash_is_detected(hot):
    _, v, _, _ = hot
    assert [r[0] for r in hot_keys(v, "CRASH_RECORD_ID", HOT_ROWS).collect()] == ["HOT"]


@pytest.mark.parametrize("name", sorted(CASES))
def test_routed_equals_plain_and_sql(hot, name):
    c, v, p, con = hot
    routed, plain = CASES[name]
    r_cols, r_rows = rows_of_spark(routed(c, v, p))
    p_cols, p_rows = rows_of_spark(plain(c, v, p))
    assert r_cols == p_cols and r_rows == p_rows
    o_cols, o_rows = rows_of_duckdb(con, SQL[name])
    assert r_cols == o_cols
    assert r_rows == o_rows, {"spark_only": r_rows - o_rows, "sql_only": o_rows - r_rows}


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """A third of the units and people without a crash id, a third copies of one row."""
    c, v, p = crash_tables(spark, SF_SMOKE)
    base = str(tmp_path_factory.mktemp("crowded"))
    con = duckdb.connect()
    out = []
    for name, df, copies in (("crashes", c, 40), ("vehicles", v, 3000), ("people", p, 5)):
        n = df.count()
        nameless = df.limit(n // 2).withColumn("CRASH_RECORD_ID", F.lit(None).cast("string")) if name != "crashes" else df.limit(0)
        one = df.filter("CRASH_RECORD_ID = '1'").limit(1)
        copied = one.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_c")
        df.unionByName(nameless).unionByName(copied).write.mode("overwrite").parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{base}/{name}/*.parquet')")
    return *out, con


@pytest.mark.parametrize("name", sorted(CASES))
def test_null_ids_and_copies_equal_plain_and_sql(crowded, name):
    c, v, p, con = crowded
    r_cols, r_rows = rows_of_spark(CASES[name][0](c, v, p))
    o_cols, o_rows = rows_of_duckdb(con, SQL[name])
    assert r_cols == o_cols
    assert r_rows == o_rows, {"spark_only": r_rows - o_rows, "sql_only": o_rows - r_rows}


def _written(df, path):
    """The rows as a job would write them: a bare count() prunes columns and hides losses."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("ties", [None, ["VEHICLE_ID"]])
def test_written_numbers_equal_the_window(spark, crowded, tmp_path, reuse, ties):
    _, v, _, _ = crowded
    wide = v.withColumn("extra", F.concat("UNIT_NO", F.col("MAKE")))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = _written(number_units(wide, tie_breakers=ties, skew_safe=True), str(tmp_path / "digits"))
        mixed = _written(number_units(wide, tie_breakers=ties, hot_rows=1000), str(tmp_path / "mixed"))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    plain = _written(number_units(wide, skew_safe=False), str(tmp_path / "plain"))
    numbers = rows_of_spark(plain.select("CRASH_RECORD_ID", "CRASH_UNIT_ID", "veh_seq_nbr"))
    for other in (got, mixed):
        assert rows_of_spark(other.select("CRASH_RECORD_ID", "CRASH_UNIT_ID", "veh_seq_nbr")) == numbers
        assert rows_of_spark(other.drop("veh_seq_nbr")) == rows_of_spark(wide)
    if ties is None:
        assert rows_of_spark(got) == rows_of_spark(plain)


def test_mixed_threshold_names_some_crashes(crowded):
    _, v, _, _ = crowded
    hot_ids, ids = hot_keys(v, "CRASH_RECORD_ID", 7).count(), v.select("CRASH_RECORD_ID").distinct().count()
    assert 0 < hot_ids < ids / 2


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory):
    """One crash whose units tie: 4,000 distinct ones lack CRASH_UNIT_ID, 4,000 distinct ones
    share all four keys, and another crash has both kinds, few enough to fill its slots."""
    _, v, _ = crash_tables(spark, SF_SMOKE)
    one = v.filter("VEHICLE_ID IS NOT NULL AND RD_NO IS NOT NULL").orderBy("CRASH_UNIT_ID").limit(1)
    many = one.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(4000))))
    distinct = F.concat(F.lit("M"), F.col("_i"))
    out = v
    for crash, nameless, equal in (("TIED-A", 4000, 4000), ("TIED-B", 2, 4000), ("TIED-C", 0, 4000), ("TIED-D", 1, 2)):
        rows = many.withColumn("CRASH_RECORD_ID", F.lit(crash)).withColumn("MAKE", distinct)
        lacking = rows.filter(F.col("_i") <= nameless).withColumn("CRASH_UNIT_ID", F.lit(None).cast("bigint"))
        out = out.unionByName(lacking.drop("_i")).unionByName(rows.filter(F.col("_i") <= equal).drop("_i"))
    return _written(out, str(tmp_path_factory.mktemp("tied") / "vehicles"))


@pytest.mark.parametrize("name", ["vehicle_summary", "vehicle_summary_fixed", "vehicle_pivot", "vehicle_slots"])
def test_tied_units_fill_the_same_slots(tied, name):
    """Every strategy that spreads a crash gives the rows of the plain window."""
    skewed = {
        "vehicle_summary": lambda v: vehicle_summary(v, strategy="topk"),
        "vehicle_summary_fixed": lambda v: vehicle_summary(v, compat=False, strategy="topk"),
        "vehicle_pivot": lambda v: vehicle_pivot(v, strategy="topk"),
        "vehicle_slots": lambda v: vehicle_slots(v, strategy="topk"),
    }[name]
    assert rows_of_spark(skewed(tied)) == rows_of_spark(CASES[name][1](None, tied, None))


def test_tied_units_are_cut_before_the_shuffle(spark, tied):
    """Rows that tie never meet: each map task sends at most n rows of a crash on."""
    from wreckline.operators.slots import slot_candidates, slot_rows

    first = slot_candidates(tied)
    assert first.filter("CRASH_RECORD_ID = 'TIED-A'").count() == 4
    text = first._jdf.queryExecution().executedPlan().toString()
    assert "row_number" in text and "Partial" in text
    rows = {r.CRASH_RECORD_ID: r["_copies"] for r in slot_rows(tied).filter("CRASH_RECORD_ID LIKE 'TIED%'").collect()}
    assert rows == {"TIED-B": 4000, "TIED-C": 4000, "TIED-D": 2}
