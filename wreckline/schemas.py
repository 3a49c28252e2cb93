"""Input schemas, projected column lists and output column orders.

Fixed values: the column names and orders below must equal the studied pipeline's,
because downstream tables and dashboards address columns by these names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: input projections -------------------------------------------------
CRASH_COLUMNS = [
    "CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", "POSTED_SPEED_LIMIT", "WEATHER_CONDITION",
    "LIGHTING_CONDITION", "FIRST_CRASH_TYPE", "STREET_NO", "STREET_DIRECTION", "STREET_NAME",
    "INJURIES_TOTAL", "INJURIES_FATAL",
]
CRASH_COLUMNS_WITH_CAUSE = CRASH_COLUMNS + ["PRIM_CONTRIBUTORY_CAUSE"]
VEHICLE_COLUMNS = [
    "CRASH_UNIT_ID", "CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", "UNIT_NO", "UNIT_TYPE",
    "NUM_PASSENGERS", "VEHICLE_ID", "CMRC_VEH_I", "MAKE", "MODEL",
]
PEOPLE_COLUMNS = [
    "PERSON_ID", "CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", "PERSON_TYPE", "SEX", "AGE",
    "INJURY_CLASSIFICATION",
]
PEOPLE_COLUMNS_WITH_VEHICLE = PEOPLE_COLUMNS + ["VEHICLE_ID"]

# --- fixed values: output column orders ------------------------------------------------
SLOT_COUNT = 4
VEHICLE_SLOT_FIELDS = ["ID", "MAKE", "MODEL"]
PERSON_SLOT_FIELDS = ["ID", "SEX", "AGE", "INJURY_CLASSIFICATION"]


def vehicle_slot_columns(n: int = SLOT_COUNT) -> list[str]:
    return [f"VEHICLE{k}_{f}" for k in range(1, n + 1) for f in VEHICLE_SLOT_FIELDS]


def person_slot_columns(n: int = SLOT_COUNT) -> list[str]:
    return [f"PERSON{k}_{f}" for k in range(1, n + 1) for f in PERSON_SLOT_FIELDS]


CALENDAR_COLUMNS = ["CRASH_MONTH", "CRASH_YEAR", "YEAR_MONTH", "DAY_OF_WEEK", "HOUR_OF_DAY"]

def vehicle_summary_columns(n: int = SLOT_COUNT) -> list[str]:
    return ["CRASH_RECORD_ID", "RD_NO", "CRASH_DATE", "Cnt_Entities_Accid", "Cnt_MotorVehicles_Accid"] + vehicle_slot_columns(n)


def vehicle_pivot_columns(n: int = SLOT_COUNT) -> list[str]:
    return ["CRASH_RECORD_ID", "RD_NO", "CRASH_DATE"] + vehicle_slot_columns(n)


def people_summary_columns(n: int = SLOT_COUNT) -> list[str]:
    return ["CRASH_RECORD_ID", "CRASH_DATE", "RD_NO", "Cnt_Drivers_Accid"] + person_slot_columns(n)


CRASH_VEHICLE_SUMMARY_COLUMNS = (
    ["CRASH_RECORD_ID", "RD_NO", "CRASH_DATE"]
    + CALENDAR_COLUMNS
    + [
        "POSTED_SPEED_LIMIT", "WEATHER_CONDITION", "LIGHTING_CONDITION", "FIRST_CRASH_TYPE",
        "STREET_NO", "STREET_DIRECTION", "STREET_NAME", "INJURIES_TOTAL", "INJURIES_FATAL",
        "CNT_ENTITIES_ACCID", "Cnt_MOTORVEHICLES_ACCID",
    ]
    + vehicle_slot_columns()
)
CRASH_SUMMARY_COLUMNS = (
    CRASH_VEHICLE_SUMMARY_COLUMNS + ["Cnt_Drivers_Accid"] + person_slot_columns()
)
VEHICLE_PERSON_DETAIL_COLUMNS = [
    "CRASH_RECORD_ID", "CRASH_DATE", "CRASH_UNIT_ID", "VEHICLE_ID", "MAKE", "Vehicle_Make",
    "MODEL", "Vehicle_Model", "UNIT_TYPE", "PERSON_ID", "PERSON_TYPE", "SEX", "AGE",
    "weather_condition", "lighting_condition", "prim_contributory_cause", "street",
    "INJURIES_TOTAL", "INJURIES_FATAL",
]
NUMBERED_VEHICLE_COLUMNS = VEHICLE_COLUMNS + ["veh_seq_nbr"]

# --- typed input schemas ---------------------------------------------------------------
_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampNTZType()

CRASH_SCHEMA = T.StructType(
    [
        T.StructField("CRASH_RECORD_ID", _S, False),
        T.StructField("RD_NO", _S),
        T.StructField("CRASH_DATE", _TS),
        T.StructField("POSTED_SPEED_LIMIT", _L),
        T.StructField("WEATHER_CONDITION", _S),
        T.StructField("LIGHTING_CONDITION", _S),
        T.StructField("FIRST_CRASH_TYPE", _S),
        T.StructField("STREET_NO", _L),
        T.StructField("STREET_DIRECTION", _S),
        T.StructField("STREET_NAME", _S),
        T.StructField("INJURIES_TOTAL", _L),
        T.StructField("INJURIES_FATAL", _L),
        T.StructField("PRIM_CONTRIBUTORY_CAUSE", _S),
    ]
)
# MODEL is text: it is compared with text values and holds brand model names.
VEHICLE_SCHEMA = T.StructType(
    [
        T.StructField("CRASH_UNIT_ID", _L, False),
        T.StructField("CRASH_RECORD_ID", _S, False),
        T.StructField("RD_NO", _S),
        T.StructField("CRASH_DATE", _TS),
        T.StructField("UNIT_NO", _S),
        T.StructField("UNIT_TYPE", _S),
        T.StructField("NUM_PASSENGERS", _S),
        T.StructField("VEHICLE_ID", _L),
        T.StructField("CMRC_VEH_I", _S),
        T.StructField("MAKE", _S),
        T.StructField("MODEL", _S),
    ]
)
PEOPLE_SCHEMA = T.StructType(
    [
        T.StructField("PERSON_ID", _S, False),
        T.StructField("CRASH_RECORD_ID", _S, False),
        T.StructField("RD_NO", _S),
        T.StructField("CRASH_DATE", _TS),
        T.StructField("PERSON_TYPE", _S),
        T.StructField("SEX", _S),
        T.StructField("AGE", _L),
        T.StructField("INJURY_CLASSIFICATION", _S),
        T.StructField("VEHICLE_ID", _L),
        T.StructField("BAC_RESULT", _S),
    ]
)
SCHEMAS = {"crash": CRASH_SCHEMA, "vehicles": VEHICLE_SCHEMA, "people": PEOPLE_SCHEMA}
