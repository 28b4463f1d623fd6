"""Number conversion and sensor arithmetic.

Functions named ``*_sql`` return expression text. Tables with dozens of sensor
columns are selected with such text, which the session parses in one call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanwatch.model import STRAIN_PER_COUNT

# Decimal text a sensor document may hold: digits may be grouped by single
# underscores, and the non-finite words may carry a sign.
_DIGITS = r"[0-9](?:_?[0-9])*"
_DECIMAL = rf"[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_NUMBER = rf"^\s*(?:{_DECIMAL}|[+-]?(?i:inf|infinity|nan))\s*$"
_NAN = r"^\s*[+-]?(?i:nan)\s*$"


def document_float_sql(doc: str, path: str, quoted: str = "true") -> str:
    """Value at ``path`` of a variant as float; null unless it reads as a number.

    Numbers, booleans and numeric text convert. Text that only a JVM would take
    for a number (``1.5f``, ``0x1p3``) gives null. ``quoted`` says whether any
    reading of the document may be text (see ``has_quoted_reading``); where it is
    false, the text rules are skipped.
    """
    number = f"try_variant_get({doc}, '{path}', 'double')"
    text = f"try_variant_get({doc}, '{path}', 'string')"
    return (
        f"cast(CASE WHEN NOT {quoted} THEN {number} "
        f"WHEN {text} RLIKE r'{_NAN}' THEN double('NaN') "
        f"WHEN {text} RLIKE r'{_NUMBER}' "
        f"THEN coalesce({number}, try_cast(replace({text}, '_', '') AS double)) "
        f"WHEN {text} IN ('true', 'false') THEN {number} END AS float)"
    )


def document_float(doc: str, path: str) -> Column:
    return F.expr(document_float_sql(doc, path))


def has_quoted_reading(line: Column) -> Column:
    """True if a one-letter key of the JSON line holds text, or may after unescaping."""
    return line.rlike(r'"[a-z]"\s*:\s*"|\\')


def resultant_sql(sensor: str) -> str:
    """Length of a sensor's acceleration vector; null if any part is null.

    The squares are formed in the precision of the columns and the root in double.
    """
    x, y, z = (f"{sensor}_{axis}" for axis in "xyz")
    return f"sqrt({x} * {x} + {y} * {y} + {z} * {z})"


def strain_mm_per_m(raw: Column) -> Column:
    """Raw gauge reading to strain in mm/m."""
    return raw.cast("double") * F.lit(STRAIN_PER_COUNT) * F.lit(1000.0)


def at_or_above(value: Column, threshold: float) -> Column:
    """``value >= threshold`` compared in single precision, as the values are stored."""
    return value >= F.lit(float(threshold)).cast("float")
