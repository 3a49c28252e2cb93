"""Text builders: NULL fallbacks, 'NA' placeholders, category clean-up, street label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The junk category values that the clean-up maps to the placeholder,
# and the placeholders themselves.
JUNK_CATEGORY_VALUES = ["OTHER (EXPLAIN IN NARRATIVE)", "UNKNOWN", " "]
CLEAN_PLACEHOLDER = "N/A"
MISSING_PLACEHOLDER = "NA"


def fallback(value: Column, other: Column) -> Column:
    """``CASE WHEN value IS NULL THEN other ELSE value END``."""
    return F.coalesce(value, other)


def na_text(value: Column) -> Column:
    """Value as text, or 'NA' when NULL (integers become their decimal text)."""
    return F.coalesce(value.cast("string"), F.lit(MISSING_PLACEHOLDER))


def clean_category(value: Column, compat: bool = True) -> Column:
    """Map junk category values to 'N/A'.

    compat: exactly the three listed values ('' and NULL pass through unchanged).
    corrected: also blank-only text and NULL.
    """
    junk = value.isin(*JUNK_CATEGORY_VALUES)
    if compat:
        return F.when(junk, F.lit(CLEAN_PLACEHOLDER)).otherwise(value)
    blank = value.isNull() | (F.trim(value) == "")
    return F.when(blank | junk, F.lit(CLEAN_PLACEHOLDER)).otherwise(value)


def street_label(number: Column, direction: Column, name: Column, compat: bool = True) -> Column:
    """'<no> <dir> <name>'. compat: NULL if any part is NULL; corrected: skip NULL parts
    (NULL only when every part is NULL)."""
    parts = [number.cast("string"), direction, name]
    if compat:
        return F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2])
    joined = F.concat_ws(" ", *parts)
    return F.when(joined != "", joined)
