"""Column builders used by the operators (no DataFrame-level work except ``with_calendar``)."""

from wreckline.functions.calendar import WEEKDAY_LABELS, truncate, weekday_label, with_calendar, year_month_label
from wreckline.functions.text import (
    CLEAN_PLACEHOLDER,
    JUNK_CATEGORY_VALUES,
    MISSING_PLACEHOLDER,
    clean_category,
    fallback,
    na_text,
    street_label,
)

__all__ = [
    "WEEKDAY_LABELS", "truncate", "weekday_label", "with_calendar", "year_month_label",
    "CLEAN_PLACEHOLDER", "JUNK_CATEGORY_VALUES", "MISSING_PLACEHOLDER", "clean_category",
    "fallback", "na_text", "street_label",
]
