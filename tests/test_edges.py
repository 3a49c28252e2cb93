"""Hand-made edge rows: every operator against the self-join SQL run by DuckDB on the
same rows, plus a few hand-computed expectations of the compat semantics."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest

from oracle_check import rows_of_duckdb, rows_of_spark  # noqa: E402
from wreckline.oracle import oracle_queries_over_views
from wreckline.operators import people_summary, vehicle_pivot, vehicle_slots, vehicle_summary
from wreckline.plans import crash_summary, crash_vehicle_summary, vehicle_person_detail
from wreckline.schemas import CRASH_SCHEMA, PEOPLE_SCHEMA, VEHICLE_SCHEMA

D = dt.datetime(2022, 4, 22, 22, 30)  # a Friday


def _crash(cid, rd="RD", date=D, direction="N", **kw):
    row = dict(CRASH_RECORD_ID=cid, RD_NO=rd, CRASH_DATE=date, POSTED_SPEED_LIMIT=30, WEATHER_CONDITION="CLEAR",
               LIGHTING_CONDITION="DAYLIGHT", FIRST_CRASH_TYPE="REAR END", STREET_NO=100,
               STREET_DIRECTION=direction, STREET_NAME="MAIN ST", INJURIES_TOTAL=1, INJURIES_FATAL=0,
               PRIM_CONTRIBUTORY_CAUSE="SPEEDING")
    row.update(kw)
    return tuple(row[f.name] for f in CRASH_SCHEMA.fields)


def _unit(cid, unit, vehicle=-1, rd="RD", date=D, make="FORD", model="F150", utype="DRIVER"):
    vehicle = unit * 10 if vehicle == -1 else vehicle
    row = dict(CRASH_UNIT_ID=unit, CRASH_RECORD_ID=cid, RD_NO=rd, CRASH_DATE=date, UNIT_NO=str(unit),
               UNIT_TYPE=utype, NUM_PASSENGERS="0", VEHICLE_ID=vehicle, CMRC_VEH_I=None, MAKE=make, MODEL=model)
    return tuple(row[f.name] for f in VEHICLE_SCHEMA.fields)


def _person(cid, pid, unit, ptype="Driver", rd="RD", date=D, sex="M", age=30, injury="NONE"):
    row = dict(PERSON_ID=pid, CRASH_RECORD_ID=cid, RD_NO=rd, CRASH_DATE=date, PERSON_TYPE=ptype, SEX=sex,
               AGE=age, INJURY_CLASSIFICATION=injury, VEHICLE_ID=unit, BAC_RESULT=None)
    return tuple(row[f.name] for f in PEOPLE_SCHEMA.fields)


def edge_rows():
    crashes, units, people = [], [], []
    # Six units -> two overflow units form their own (2,2) group
    crashes.append(_crash("E1"))
    units += [_unit("E1", u) for u in range(1, 7)]
    # Five units -> the single overflow unit is (1,1) and merges with the slot row
    crashes.append(_crash("E2"))
    units += [_unit("E2", u) for u in range(11, 16)]
    # Second unit has no VEHICLE_ID -> extra (1,0) row, slot 2 empty
    crashes.append(_crash("E3"))
    units += [_unit("E3", 21), _unit("E3", 22, vehicle=None, utype="PEDESTRIAN", make=None)]
    # Crash without RD_NO: its summaries never join
    crashes.append(_crash("E4", rd=None))
    units += [_unit("E4", 31, rd=None)]
    people += [_person("E4", "E4-P1", 31, rd=None)]
    # E5: unit and driver with NULL date
    crashes.append(_crash("E5"))
    units += [_unit("E5", 41), _unit("E5", 42, date=None)]
    people += [_person("E5", "E5-P1", 41), _person("E5", "E5-P2", 42, date=None),
               _person("E5", "E5-P3", 42, date=None, sex=None)]
    # Crash without units or people
    crashes.append(_crash("E6"))
    # One crash per weekday (2022-04-17 is a Sunday)
    for i in range(7):
        crashes.append(_crash(f"E7-{i}", date=dt.datetime(2022, 4, 17 + i, 8, 0)))
    # Drivers aged 9, 10 and NULL in one crash
    crashes.append(_crash("E8"))
    units += [_unit("E8", 81), _unit("E8", 82), _unit("E8", 83)]
    people += [_person("E8", "E8-A", 81, age=9), _person("E8", "E8-B", 82, age=10),
               _person("E8", "E8-C", 83, age=None, injury=None)]
    # Junk make / model values
    crashes.append(_crash("E9"))
    for i, value in enumerate([None, "", " ", "UNKNOWN", "OTHER (EXPLAIN IN NARRATIVE)", "FORD"]):
        units.append(_unit("E9", 91 + i, make=value, model=value))
    # NULL street direction
    crashes.append(_crash("E10", direction=None))
    units += [_unit("E10", 101)]
    # Person types differ in case
    crashes.append(_crash("E11"))
    units += [_unit("E11", 111)]
    people += [_person("E11", "E11-A", 111, ptype="Driver"), _person("E11", "E11-B", 111, ptype="DRIVER"),
               _person("E11", "E11-C", 111, ptype="Passenger")]
    # Exact duplicate unit row
    crashes.append(_crash("E12"))
    units += [_unit("E12", 121), _unit("E12", 121), _unit("E12", 122)]
    # The same crash row twice (the GROUP BY over all output columns keeps one)
    crashes += [_crash("E13"), _crash("E13")]
    units += [_unit("E13", 131), _unit("E13", 132)]
    people += [_person("E13", "E13-P1", 131)]
    # One crash id under two dates and two RD_NOs, units under both dates
    later = dt.datetime(2022, 4, 23, 1, 0)
    crashes += [_crash("E14"), _crash("E14", date=later), _crash("E14", rd="RD2"), _crash("E14", date=later)]
    units += [_unit("E14", 141), _unit("E14", 142, date=later), _unit("E14", 143, rd="RD2")]
    people += [_person("E14", "E14-P1", 141), _person("E14", "E14-P2", 142, date=later)]
    # Two units with one CRASH_UNIT_ID that differ in UNIT_NO first, then in make
    crashes.append(_crash("E15"))
    for number, make in (("2", "A"), ("1", "Z")):
        tied = list(_unit("E15", 151, make=make))
        tied[[f.name for f in VEHICLE_SCHEMA.fields].index("UNIT_NO")] = number
        units.append(tuple(tied))
    # Drivers that occur again, as they are, with other values and with another RD_NO
    crashes += [_crash("E16"), _crash("E16", rd="RD2")]
    units += [_unit("E16", 161), _unit("E16", 162)]
    people += [_person("E16", "E16-A", 161)] * 2 + [_person("E16", "E16-A", 161, sex="F", age=None)]
    people += [_person("E16", "E16-B", 162), _person("E16", "E16-B", 162, rd="RD2", injury=None)]
    return crashes, units, people


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    crashes, units, people = edge_rows()
    base = tmp_path_factory.mktemp("edge")
    frames = {
        "crashes": spark.createDataFrame(crashes, CRASH_SCHEMA),
        "vehicles": spark.createDataFrame(units, VEHICLE_SCHEMA),
        "people": spark.createDataFrame(people, PEOPLE_SCHEMA),
    }
    con = duckdb.connect()
    out = {}
    for name, df in frames.items():
        path = os.path.join(base, name)
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return out["crashes"], out["vehicles"], out["people"], con


SQL = oracle_queries_over_views()

CASES = {
    "vehicle_summary": lambda c, v, p: vehicle_summary(v, strategy="window"),
    "vehicle_summary_topk": lambda c, v, p: vehicle_summary(v, strategy="topk"),
    "vehicle_summary_join": lambda c, v, p: vehicle_summary(v, strategy="lookup"),
    "vehicle_summary_mixed": lambda c, v, p: vehicle_summary(v, hot_rows=3),
    "vehicle_summary_fixed": lambda c, v, p: vehicle_summary(v, compat=False, strategy="window"),
    "vehicle_summary_fixed_topk": lambda c, v, p: vehicle_summary(v, compat=False, strategy="topk"),
    "vehicle_slots": lambda c, v, p: vehicle_slots(v),
    "vehicle_pivot": lambda c, v, p: vehicle_pivot(v, strategy="window"),
    "vehicle_pivot_topk": lambda c, v, p: vehicle_pivot(v, strategy="topk"),
    "people_summary": lambda c, v, p: people_summary(p),
    "people_summary_fixed": lambda c, v, p: people_summary(p, compat=False, strategy="cluster"),
    "people_summary_fixed_topk": lambda c, v, p: people_summary(p, compat=False, strategy="partial"),
    "people_summary_partial": lambda c, v, p: people_summary(p, strategy="partial"),
    "people_summary_mixed": lambda c, v, p: people_summary(p, hot_rows=2),
    "crash_summary": lambda c, v, p: crash_summary(c, v, p),
    "crash_summary_fixed": lambda c, v, p: crash_summary(c, v, p, compat=False),
    "crash_vehicle_summary": lambda c, v, p: crash_vehicle_summary(c, v),
    # crash ids with 2+ rows (E13 copies, E14) take the copies-safe crash side
    "crash_summary_mixed": lambda c, v, p: crash_summary(c, v, p, hot_rows=2),
    "crash_summary_topk": lambda c, v, p: crash_summary(c, v, p, strategy="topk"),
    "crash_vehicle_summary_mixed": lambda c, v, p: crash_vehicle_summary(c, v, hot_rows=2),
    "vehicle_person_detail_spread": lambda c, v, p: vehicle_person_detail(c, v, p, strategy="spread"),
    "vehicle_person_detail": lambda c, v, p: vehicle_person_detail(c, v, p),
    "vehicle_person_detail_fixed": lambda c, v, p: vehicle_person_detail(c, v, p, compat=False),
    "vehicle_person_detail_mixed": lambda c, v, p: vehicle_person_detail(c, v, p, hot_rows=3),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_edge_rows_match_self_join_sql(edge, name):
    c, v, p, con = edge
    sql_name = {"vehicle_summary_mixed": "vehicle_summary", "people_summary_mixed": "people_summary",
                "vehicle_person_detail_mixed": "vehicle_person_detail", "crash_summary_mixed": "crash_summary",
                "crash_summary_topk": "crash_summary", "crash_vehicle_summary_mixed": "crash_vehicle_summary",
                "vehicle_person_detail_spread": "vehicle_person_detail"}.get(name, name)
    s_cols, s_rows = rows_of_spark(CASES[name](c, v, p))
    o_cols, o_rows = rows_of_duckdb(con, SQL[sql_name])
    assert s_cols == o_cols
    assert s_rows == o_rows, {"spark_only": s_rows - o_rows, "sql_only": o_rows - s_rows}


def _by_crash(df, crash):
    return [r.asDict() for r in df.filter(df.CRASH_RECORD_ID == crash).collect()]


def test_overflow_units_form_their_own_row(edge):
    c, v, p, _ = edge
    rows = _by_crash(vehicle_summary(v, strategy="topk"), "E1")
    counts = sorted((r["Cnt_Entities_Accid"], r["Cnt_MotorVehicles_Accid"]) for r in rows)
    assert counts == [(1, 1), (2, 2)]
    slot_row = [r for r in rows if r["Cnt_Entities_Accid"] == 1][0]
    assert [slot_row[f"VEHICLE{k}_ID"] for k in range(1, 5)] == [1, 2, 3, 4]


def test_single_overflow_unit_merges(edge):
    _, v, _, _ = edge
    rows = _by_crash(vehicle_summary(v, strategy="topk"), "E2")
    assert len(rows) == 1 and rows[0]["VEHICLE4_ID"] == 14


def test_unit_without_vehicle_id_never_fills_a_slot(edge):
    _, v, _, _ = edge
    rows = _by_crash(vehicle_summary(v, strategy="topk"), "E3")
    assert sorted((r["Cnt_Entities_Accid"], r["Cnt_MotorVehicles_Accid"]) for r in rows) == [(1, 0), (1, 1)]
    fixed = _by_crash(vehicle_summary(v, compat=False, strategy="topk"), "E3")
    assert len(fixed) == 1 and fixed[0]["Cnt_Entities_Accid"] == 2 and fixed[0]["VEHICLE2_ID"] is None


def test_text_max_of_ages(edge):
    _, _, p, _ = edge
    rows = _by_crash(people_summary(p), "E8")
    assert {r["PERSON1_AGE"] for r in rows} == {"NA"}  # 'NA' > '9' > '10'
    # slot 1's injury column carries the age ('9', '10') or 'NA' (missing injury)
    assert rows[0]["PERSON1_INJURY_CLASSIFICATION"] == "NA"
    assert rows[0]["PERSON2_INJURY_CLASSIFICATION"] == "NONE"
    fixed = _by_crash(people_summary(p, compat=False), "E8")[0]
    assert [fixed[f"PERSON{k}_AGE"] for k in (1, 2, 3)] == ["9", "10", "NA"]
    assert fixed["Cnt_Drivers_Accid"] == 3


def test_weekday_labels(edge):
    c, v, p, _ = edge
    from wreckline.plans import crash_calendar

    got = {r["CRASH_RECORD_ID"]: r["DAY_OF_WEEK"] for r in crash_calendar(c).collect()}
    fixed = {r["CRASH_RECORD_ID"]: r["DAY_OF_WEEK"] for r in crash_calendar(c, compat=False).collect()}
    names = ["SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY"]
    assert [fixed[f"E7-{i}"] for i in range(7)] == names
    assert [got[f"E7-{i}"] for i in range(7)] == names[1:] + [None]


def test_rd_no_null_never_joins(edge):
    c, v, p, _ = edge
    row = _by_crash(crash_summary(c, v, p), "E4")[0]
    assert row["CNT_ENTITIES_ACCID"] is None and row["Cnt_Drivers_Accid"] is None
    fixed = _by_crash(crash_summary(c, v, p, compat=False), "E4")[0]
    assert fixed["CNT_ENTITIES_ACCID"] == 1 and fixed["Cnt_Drivers_Accid"] == 1


@pytest.mark.parametrize("n", [1, 2, 6])
def test_slot_count_is_honoured(edge, n):
    _, v, p, _ = edge
    summaries = [rows_of_spark(vehicle_summary(v, n=n, strategy=s)) for s in ("window", "topk", "lookup")]
    assert summaries[0] == summaries[1] == summaries[2] and f"VEHICLE{n}_ID" in summaries[0][0]
    assert f"VEHICLE{n + 1}_ID" not in summaries[0][0]
    fixed = [rows_of_spark(vehicle_summary(v, compat=False, n=n, strategy=s)) for s in ("window", "topk")]
    assert fixed[0] == fixed[1]
    pivots = [rows_of_spark(vehicle_pivot(v, n=n, strategy=s)) for s in ("window", "topk")]
    assert pivots[0] == pivots[1]
    for compat in (True, False):
        drivers = [rows_of_spark(people_summary(p, compat=compat, n=n, strategy=s)) for s in ("cluster", "partial")]
        assert drivers[0] == drivers[1] and len(drivers[0][0]) == 4 + 4 * n
    if n == 6:
        e1 = _by_crash(vehicle_summary(v, n=6, strategy="topk"), "E1")
        assert len(e1) == 1 and [e1[0][f"VEHICLE{k}_ID"] for k in range(1, 7)] == [1, 2, 3, 4, 5, 6]


def test_repeated_drivers_count_without_overflow(spark):
    from wreckline.operators import person_slots

    people = spark.createDataFrame([_person("C", "P", 1)] * 7000 + [_person("C", "Q", 1)] * 3, PEOPLE_SCHEMA)
    for strategy in ("cluster", "partial"):
        counts = sorted(r.Cnt_Drivers_Accid for r in people_summary(people, strategy=strategy).collect())
        assert counts == [3**5, 2**63 - 1]  # 7000 ** 5 is beyond bigint
    packed = {r.PERSON_ID: r["copies"] for r in person_slots(people, expand=False).collect()}
    assert packed == {"P": 2**63 - 1, "Q": 3**5}
    assert person_slots(people.filter("PERSON_ID = 'Q'")).count() == 3**5


def test_slots_of_repeated_drivers_against_the_self_joins(spark):
    from itertools import product

    from wreckline.operators import person_slots
    from wreckline.functions.text import MISSING_PLACEHOLDER as na

    def at(key, sex, age, injury, rd="R"):
        return dict(zip(PEOPLE_SCHEMA.names, _person("C", key, 1, rd=rd, sex=sex, age=age, injury=injury), strict=True))

    given = [at("P", "F", 30, "MINOR"), at("P", "F", 30, "MINOR"), at("P", None, 31, None, "S"), at("P", "NA", 31, None, None),
             at("Q", "M", None, "FATAL"), at(None, "M", 40, "FATAL"), at(None, "F", 41, None)]
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PEOPLE_SCHEMA.fields)
    people = spark.createDataFrame([tuple(x.values()) for x in given], nullable)

    def text(value):
        return na if value is None else str(value)

    def injury_shown(x, k):
        age = None if x["AGE"] is None else str(x["AGE"])
        return age if k == 0 and x["INJURY_CLASSIFICATION"] is not None else text(x["INJURY_CLASSIFICATION"])

    want = []
    for me in given:
        same = [x for x in given if x["PERSON_ID"] == me["PERSON_ID"]] if me["PERSON_ID"] else [dict.fromkeys(me)]
        for four in product(same, repeat=4):
            slots = [(x["PERSON_ID"], text(x["SEX"]), text(x["AGE"]), injury_shown(x, k)) for k, x in enumerate(four)]
            want.append((me["PERSON_ID"], me["RD_NO"], *[v for s in slots for v in s]))
    columns = ["PERSON_ID", "RD_NO", *[f"PERSON{k}_{f}" for k in range(1, 5) for f in ("ID", "SEX", "AGE", "INJURY_CLASSIFICATION")]]
    got = [tuple(r) for r in person_slots(people).select(*columns).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    packed = person_slots(people, expand=False)
    assert packed.agg({"copies": "sum"}).first()[0] == len(want)
    assert packed.distinct().count() == packed.count()
