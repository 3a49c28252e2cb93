"""Sources and sinks: Parquet / CSV readers, CSV landing with quarantine, Parquet and
catalog sinks, and the test-table mapping."""

from wreckline.sources.derived import crash_tables, land_crash_tables
from wreckline.sources.ingest import csv_quarantine, csv_to_parquet, ingest_datasets
from wreckline.sources.readers import (
    load_crashes,
    load_parquet,
    load_people,
    load_vehicles,
    read_csv_table,
    read_with_schema,
)
from wreckline.sources.sinks import publish_table, register_external, stage_parquet, write_parquet, write_table

__all__ = [
    "crash_tables", "land_crash_tables", "csv_quarantine", "csv_to_parquet", "ingest_datasets", "load_crashes",
    "load_parquet", "load_people", "load_vehicles", "read_csv_table", "read_with_schema",
    "publish_table", "register_external", "stage_parquet", "write_parquet", "write_table",
]
