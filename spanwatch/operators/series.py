"""Report series: temperatures, strain beside temperature, resultant acceleration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.functions import (
    bin_number,
    bin_start,
    day_label,
    hours_since_midnight,
    numbered_bin_start,
    resultant_sql,
    strain_mm_per_m,
)
from spanwatch.model import ACCELEROMETERS, GAUGES, HUB_SENSORS, HUBS, THERMOMETERS, hub_of
from spanwatch.operators.medians import exact_median
from spanwatch.operators.registry import gauge_series, registry, with_sensor
from spanwatch.operators.timewindow import (
    Window,
    as_stamp,
    day_span,
    time_window,
    within,
)

Tables = dict[str, DataFrame]

COLUMN_THERMOMETERS = HUB_SENSORS["hub1"]["T"]
ARCH_THERMOMETERS = [t for t in THERMOMETERS if t not in COLUMN_THERMOMETERS]


def mean_series(frame: DataFrame, columns: list[str], minutes: int) -> DataFrame:
    """Mean of each column per bin; one pass whatever the number of columns."""
    return frame.groupBy(bin_start("datetime", minutes).alias("bin_start")).agg(
        F.lit(minutes).alias("bin_minutes"), *[F.avg(c).alias(c) for c in columns]
    )


def temps_col(tables: Tables, minutes: int = 60, window: Window | None = None) -> DataFrame:
    """Mean column temperatures per bin, last seven days unless a window is given."""
    frame = tables["sst_hub1"]
    window = window or time_window(frame)
    return mean_series(within(frame, window), COLUMN_THERMOMETERS, minutes)


def temps_arch(tables: Tables, minutes: int = 60, window: Window | None = None) -> DataFrame:
    """Mean arch temperatures on one axis; the thermometers sit on three hubs.

    The rows of the three tables are stacked and grouped once, which gives the same
    axis as joining three results by bin.
    """
    parts = {t: tables[f"sst_{hub_of(t)}"] for t in ARCH_THERMOMETERS}
    window = window or time_window(list(parts.values()))
    stacked = None
    for name, frame in parts.items():
        part = within(frame, window).select("datetime", name)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return mean_series(stacked, ARCH_THERMOMETERS, minutes)


# Gauges and thermometers by number, to pack a series and a bin into one long.
SERIES = GAUGES + THERMOMETERS
SLOTS = len(SERIES)


def hub_series(frame: DataFrame, columns: list[str], minutes: int) -> DataFrame:
    """One row per value: its series and bin as ``slot``, and the value."""
    return binned_series(frame.select(bin_number("datetime", minutes).alias("bin"), *columns), columns)


def binned_series(binned: DataFrame, columns: list[str]) -> DataFrame:
    """As :func:`hub_series`, from wide rows that have the number of their ``bin``."""
    pairs = ", ".join(f"{SERIES.index(c)}, {c}" for c in columns)
    values = binned.selectExpr("bin", f"stack({len(columns)}, {pairs}) AS (series, v)")
    # The rows have a time, so a slot is never null; the fallback lets the planner know.
    slot = F.coalesce(F.col("bin") * SLOTS + F.col("series"), F.lit(0).cast("long"))
    return values.select(slot.alias("slot"), "v")


def strain_temp(
    tables: Tables,
    gauges: list[str] = GAUGES,
    minutes: int = 60,
    start=None,
    end=None,
    window: Window | dict[str, Window] | None = None,
) -> DataFrame:
    """Median strain and median temperature per gauge and bin, with labels.

    Each hub's own last seven days unless a window, or one for each hub, is given. Every series is reduced
    once; a thermometer shared by several gauges is paired with them afterwards, on
    the medians.
    """
    stacked = None
    for hub in HUBS:
        wanted = [g for g in HUB_SENSORS[hub]["S"] if g in gauges]
        if not wanted:
            continue
        frame = tables[f"sst_{hub}"]
        own = window[hub] if isinstance(window, dict) else window
        inside = within(frame, own or time_window(frame, start, end))
        part = hub_series(inside, wanted + HUB_SENSORS[hub]["T"], minutes)
        stacked = part if stacked is None else stacked.unionByName(part)
    spark = tables["sst_hub1"].sparkSession
    pairs = gauge_series(spark, gauges)
    names = F.array(*[F.lit(name) for name in SERIES])
    medians = exact_median(stacked, ["slot"], "v").select(
        F.get(names, F.pmod("slot", F.lit(SLOTS)).cast("int")).alias("series"),
        numbered_bin_start(F.floor(F.col("slot") / SLOTS), minutes).alias("bin_start"),
        "median",
    )
    paired = medians.join(F.broadcast(pairs), "series")
    value = F.col("median")
    wide = paired.groupBy("sensor_id", "bin_start").agg(
        F.max(F.when(F.col("role") == "strain", value)).alias("strain_raw"),
        F.max(F.when(F.col("role") == "temp", value)).alias("temp"),
    )
    labelled = with_sensor(wide, registry(spark), ["temp_sensor_id", "label"])
    return labelled.select(
        "sensor_id",
        "label",
        "temp_sensor_id",
        "bin_start",
        F.lit(minutes).alias("bin_minutes"),
        "strain_raw",
        strain_mm_per_m(F.col("strain_raw")).alias("epsilon_mm"),
        "temp",
    )


def check_accelerometers(frame: DataFrame, sensors: list[str]) -> None:
    missing = [f"{s}_{a}" for s in sensors for a in "xyz" if f"{s}_{a}" not in frame.columns]
    if missing:
        raise ValueError(f"columns not in the acceleration table: {missing}")


def spread_sql(column: str) -> str:
    return (
        f"named_struct('v_avg', avg({column}), 'v_min', min({column}), 'v_max', max({column}))"
    )


def accel_minute(
    accel: DataFrame, sensors: list[str] = ACCELEROMETERS, window: Window | None = None
) -> DataFrame:
    """Mean, least and greatest resultant per sensor and minute.

    All sensors are reduced in one pass over the wide rows and only the reduced
    rows are turned into one row per sensor.
    """
    check_accelerometers(accel, sensors)
    frame = accel if window is None else within(accel, window)
    lengths = frame.select(
        bin_start("datetime", 1).alias("minute"),
        *[F.expr(resultant_sql(s)).alias(s) for s in sensors],
    )
    reduced = lengths.groupBy("minute").agg(*[F.expr(spread_sql(s)).alias(s) for s in sensors])
    rows = reduced.unpivot(["minute"], sensors, "sensor_id", "v")
    return rows.select("sensor_id", "minute", "v.v_avg", "v.v_min", "v.v_max")


# Days of a report's grid.
GRID_DAYS = 7


def accel_daily_grid(
    accel: DataFrame, sensors: list[str] = ACCELEROMETERS, start=None, end=None, days: int | None = GRID_DAYS
) -> DataFrame:
    """Minute resultants placed on a grid of days by hours, for the last ``days`` days.

    A report draws seven days and passes over earlier ones, also after a given
    start. With ``days=None`` the grid has all days from the start on, or from the
    first row of the table. A day without data has one row per sensor with empty
    values, so that the grid stays complete.
    """
    check_accelerometers(accel, sensors)
    whole = days is None and start is None

    def first_day(high: Column) -> Column:
        if whole:
            return F.min("datetime").cast("date") if end is None else accel.agg(F.min("datetime")).scalar().cast("date")
        if start is None:
            low = high - day_span(days)
        else:
            low = as_stamp(start)
        if days is None:
            return low.cast("date")
        return F.greatest(low.cast("date"), F.date_sub(high.cast("date"), days - 1))

    def days_until(high: Column, first: Column) -> Column:
        last = high.cast("date")
        return F.explode(F.when(first <= last, F.sequence(first, last))).alias("day")

    stamp = F.col("datetime")
    if end is None:
        latest = F.max("datetime")
        first = accel.agg(first_day(latest).cast("timestamp_ntz")).scalar()
        inside = accel.where(stamp.isNotNull() if whole else stamp >= first)
        bounds = accel.agg(first_day(latest).alias("first"), latest.alias("high"))
        spine_days = bounds.select(days_until(F.col("high"), F.col("first")))
    else:
        high = as_stamp(end)
        after = F.date_add(high.cast("date"), 1).cast("timestamp_ntz")
        inside = accel.where((stamp >= first_day(high).cast("timestamp_ntz")) & (stamp < after))
        spine_days = accel.sparkSession.range(1).select(days_until(high, first_day(high)))
    minutes = accel_minute(inside, sensors)
    placed = minutes.select(
        "sensor_id",
        F.col("minute").cast("date").alias("day"),
        hours_since_midnight("minute").alias("hour"),
        "v_avg",
        "v_min",
        "v_max",
    )
    spine = spine_days.select(
        "day", F.explode(F.array(*[F.lit(s) for s in sensors])).alias("sensor_id")
    )
    grid = spine.join(placed, ["sensor_id", "day"], "left")
    return grid.select(
        "sensor_id", "day", day_label("day").alias("day_label"), "hour", "v_avg", "v_min", "v_max"
    )


def accel_day_range(grid: DataFrame) -> DataFrame:
    """Least and greatest resultant per sensor and day of a daily grid."""
    return grid.groupBy("sensor_id", "day").agg(
        F.min("v_min").alias("y_min"), F.max("v_max").alias("y_max")
    )
