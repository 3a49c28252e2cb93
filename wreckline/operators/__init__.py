"""DataFrame -> DataFrame operators."""

from wreckline.operators.basic import (
    assert_unique_key,
    dedup_rows,
    duplicate_keys,
    filter_drivers,
    preview,
    sanitize_columns,
    vehicles_of_crash,
)
from wreckline.operators.contract import apply_output_contract
from wreckline.operators.sequence import number_by_bounds, number_units
from wreckline.operators.slots import slot_candidates, slot_table, vehicle_slots
from wreckline.operators.summaries import (
    multi_vehicle_crashes,
    people_summary,
    person_slots,
    vehicle_pivot,
    vehicle_summary,
)

__all__ = [
    "assert_unique_key", "dedup_rows", "duplicate_keys", "filter_drivers", "preview",
    "sanitize_columns", "vehicles_of_crash", "apply_output_contract", "number_units",
    "number_by_bounds", "slot_candidates", "slot_table", "vehicle_slots",
    "multi_vehicle_crashes", "people_summary", "person_slots", "vehicle_pivot", "vehicle_summary",
]
