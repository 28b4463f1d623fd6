"""Column expressions; no Python runs per row."""

from spanwatch.functions.calendar import (
    bin_number,
    bin_start,
    day_index,
    day_label,
    hours_since_midnight,
    iso_week,
    iso_year,
    numbered_bin_start,
    parse_iso,
    week_label,
    week_start,
)
from spanwatch.functions.numeric import (
    at_or_above,
    document_float,
    document_float_sql,
    has_quoted_reading,
    resultant_sql,
    strain_mm_per_m,
)

__all__ = [
    "at_or_above",
    "bin_number",
    "bin_start",
    "day_index",
    "day_label",
    "document_float",
    "document_float_sql",
    "has_quoted_reading",
    "hours_since_midnight",
    "iso_week",
    "iso_year",
    "numbered_bin_start",
    "parse_iso",
    "resultant_sql",
    "strain_mm_per_m",
    "week_label",
    "week_start",
]
