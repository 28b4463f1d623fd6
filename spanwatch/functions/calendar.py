"""Dates, ISO weeks, time bins and ISO text on zone-free timestamps.

Nothing here passes through the zoned timestamp type, so results do not depend on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO text: date, optional time after any one separator, optional offset.
_ISO = (
    r"^(\d{4}-\d{2}-\d{2})"
    r"(?:.(\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?)"
    r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bin_start(ts, minutes: int) -> Column:
    """Start of the ``minutes``-wide bin, counted from 1970-01-01 00:00."""
    if int(minutes) <= 0:
        raise ValueError("bin width must be a positive number of minutes")
    return F.window(_col(ts), f"{int(minutes)} minutes")["start"]


def bin_number(ts, minutes: int) -> Column:
    """Number of the bin, counted from 1970-01-01 00:00, as a compact grouping key."""
    ts = _col(ts)
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return F.floor((days * 1440 + F.hour(ts) * 60 + F.minute(ts)) / F.lit(int(minutes)))


def numbered_bin_start(number, minutes: int) -> Column:
    """Start of the bin with this number."""
    origin = F.lit("1970-01-01").cast("timestamp_ntz")
    seconds = (_col(number) * int(minutes) * 60).cast("decimal(18,6)")
    return origin + F.make_dt_interval(secs=seconds)


def week_start(ts) -> Column:
    """Monday of the ISO week, as a date."""
    return F.trunc(_col(ts).cast("date"), "week")


def iso_year(ts) -> Column:
    """Year the ISO week belongs to (2024-12-30 is in 2025)."""
    return F.extract(F.lit("YEAROFWEEK"), _col(ts).cast("date")).cast("int")


def iso_week(ts) -> Column:
    return F.weekofyear(_col(ts).cast("date"))


def week_label(year, week) -> Column:
    """``2025W09``: year and zero-padded ISO week."""
    return F.format_string("%dW%02d", _col(year), _col(week))


def day_index(ts) -> Column:
    """Day within the ISO week, Monday = 1."""
    return (F.weekday(_col(ts).cast("date")) + F.lit(1)).cast("int")


def day_label(day) -> Column:
    """``05. Mar.``"""
    return F.date_format(_col(day), "dd. MMM.")


def hours_since_midnight(ts) -> Column:
    ts = _col(ts)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    return seconds / F.lit(3600.0)


def parse_iso(text) -> Column:
    """ISO text to a zone-free timestamp; an offset is applied, then dropped.

    ``10:00+02:00`` becomes 08:00. Text that is not ISO, or not a real date, gives
    null. The text is matched first because a plain cast also accepts a bare year
    or a bare time of day.
    """
    text = _col(text)

    def part(i: int) -> Column:
        return F.regexp_extract(text, _ISO, i)

    date, time, offset = part(1), part(2), part(3)
    clock = F.when(F.length(time) == 2, F.concat(time, F.lit(":00"))).otherwise(
        F.translate(time, ",", ".")
    )
    naive = F.when(F.length(time) > 0, F.concat_ws(" ", date, clock)).otherwise(date)
    stamp = naive.try_cast("timestamp_ntz")
    digits = F.rpad(F.translate(offset, "+-:Z", ""), 6, "0")
    seconds = (
        F.substring(digits, 1, 2).try_cast("int") * 3600
        + F.substring(digits, 3, 2).try_cast("int") * 60
        + F.substring(digits, 5, 2).try_cast("int")
    )
    sign = F.when(offset.startswith("-"), F.lit(1)).otherwise(F.lit(-1))
    shift = F.make_dt_interval(secs=(seconds * sign).cast("decimal(18,6)"))
    general = F.when(offset.isin("", "Z"), stamp).otherwise(stamp + shift)
    # The usual form needs no matching.
    usual = F.translate(text, "123456789", "000000000") == "0000-00-00T00:00:00.000000"
    return F.when(usual, text.try_cast("timestamp_ntz")).otherwise(general)
