"""End-to-end transforms and the ingest -> transform -> publish run."""

from wreckline.plans.transforms import (
    clean_make_model,
    crash_calendar,
    crash_summary,
    crash_vehicle_summary,
    street_labels,
    vehicle_person_detail,
)
from wreckline.plans.publish import run_pipeline, transform

__all__ = [
    "clean_make_model", "crash_calendar", "crash_summary", "crash_vehicle_summary",
    "street_labels", "vehicle_person_detail", "run_pipeline", "transform",
]
