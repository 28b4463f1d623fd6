"""Time windows, their bounds, and week and day spines.

A bound taken from the data is a scalar subquery: it stays in the plan, reaches
the scan as a filter, and nothing is collected to the driver. A bound no row can
lie beyond, such as the table's own latest time, is left open; two subqueries over
one table would be merged by the optimizer and then no longer reach the scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.functions import iso_week, iso_year, week_label, week_start

Window = tuple[Column | None, Column | None]


def day_span(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(int(n)))


def as_stamp(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def _stamps(frames: list[DataFrame]) -> DataFrame:
    stamps = frames[0].select("datetime")
    for frame in frames[1:]:
        stamps = stamps.unionAll(frame.select("datetime"))
    return stamps


# Length of a report window that is not given.
DEFAULT_DAYS = 7


def time_window(frames, start=None, end=None, days: int = DEFAULT_DAYS, latest: Column | None = None) -> Window:
    """Closed window of one table or several.

    The end is the given one or the latest time in any of the tables; the start is
    the given one or ``days`` before the end. ``latest`` is that time where it is known,
    as from the week statistics of stored tables, which are then not read for it.
    """
    if start is not None:
        low = as_stamp(start)
    elif end is not None:
        low = as_stamp(end) - day_span(days)
    elif latest is not None:
        low = latest - day_span(days)
    else:
        frames = [frames] if isinstance(frames, DataFrame) else list(frames)
        low = _stamps(frames).agg(F.max("datetime") - day_span(days)).scalar()
    return low, None if end is None else as_stamp(end)


# From the earliest to the latest time of the tables: all rows that have a time.
FULL_WINDOW: Window = (None, None)


def _week_number(stamp: Column) -> Column:
    return iso_year(stamp) * 100 + iso_week(stamp)


def within(frame: DataFrame, window: Window) -> DataFrame:
    """Rows inside a closed window; rows without a time are outside any.

    A stored table read with its week columns is also filtered by them, so that other
    weeks are not opened. A document's offset can move its time out of the week it is
    filed under by a day at most; one week more on each side covers that.
    """
    low, high = window
    stamp = F.col("datetime")
    inside = stamp.isNotNull()
    filed = F.col("iso_year") * 100 + F.col("iso_week") if {"iso_year", "iso_week"} <= set(frame.columns) else None
    if low is not None:
        inside = inside & (stamp >= low)
        if filed is not None:
            inside = inside & (filed >= _week_number(low - day_span(7)))
    if high is not None:
        inside = inside & (stamp <= high)
        if filed is not None:
            inside = inside & (filed <= _week_number(high + day_span(7)))
    return frame.where(inside)


def within_week(frame: DataFrame, year: int, week: int) -> DataFrame:
    """Rows of one ISO week, Monday 00:00 up to but not including the next."""
    monday = as_stamp(date.fromisocalendar(year, week, 1))
    return within(frame, (monday, monday + day_span(7))).where(F.col("datetime") < monday + day_span(7))


def range_filter(frame: DataFrame, start, end) -> DataFrame:
    """Rows with ``start <= datetime <= end``."""
    return within(frame, (as_stamp(start), as_stamp(end)))


def last_days(frame: DataFrame, days: int = DEFAULT_DAYS) -> DataFrame:
    """Rows of the last ``days`` before the table's latest time."""
    return within(frame, time_window(frame, days=days))


def time_bounds(tables: dict[str, DataFrame]) -> DataFrame:
    """Earliest and latest time per table."""
    bounds = None
    for key, frame in tables.items():
        row = frame.agg(
            F.lit(key).alias("table_key"),
            F.min("datetime").alias("start_dt"),
            F.max("datetime").alias("end_dt"),
        )
        bounds = row if bounds is None else bounds.unionByName(row)
    return bounds


def time_bounds_multi(frames: list[DataFrame]) -> DataFrame:
    """Earliest and latest time over several tables; tables without rows do not count."""
    return _stamps(frames).agg(
        F.min("datetime").alias("start_dt"), F.max("datetime").alias("end_dt")
    )


def describe_week(stamp) -> list[Column]:
    """ISO year, week, label, Monday, Sunday and the Monday after, for a time column."""
    monday = week_start(stamp)
    return [
        iso_year(stamp).alias("iso_year"),
        iso_week(stamp).alias("iso_week"),
        week_label(iso_year(stamp), iso_week(stamp)).alias("week"),
        monday.alias("monday"),
        F.date_add(monday, 6).alias("sunday"),
        F.date_add(monday, 7).alias("next_monday"),
    ]


def weeks_between(first: Column, last: Column) -> Column:
    """All Mondays from the week of ``first`` to the week of ``last``, as an array."""
    return F.sequence(week_start(first), week_start(last), F.make_dt_interval(days=F.lit(7)))


def week_spine(frames) -> DataFrame:
    """Every ISO week from the earliest to the latest row, including weeks without rows."""
    frames = [frames] if isinstance(frames, DataFrame) else list(frames)
    bounds = time_bounds_multi(frames)
    mondays = bounds.select(F.explode(weeks_between(F.col("start_dt"), F.col("end_dt"))).alias("d"))
    return mondays.select(*describe_week("d"))


def week_spine_between(
    spark: SparkSession, first: tuple[int, int], last: tuple[int, int]
) -> DataFrame:
    """Every ISO week from ``first`` to ``last``, each given as (year, week)."""
    start = F.lit(date.fromisocalendar(*first, 1))
    end = F.lit(date.fromisocalendar(*last, 1))
    mondays = spark.range(1).select(F.explode(weeks_between(start, end)).alias("d"))
    return mondays.select(*describe_week("d"))
