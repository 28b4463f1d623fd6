"""Gaps: runs of time bins in which a sensor has no value.

The bins of a sensor are looked at week by week, so no task has a whole sensor. The
first and last bin of every week are then stitched at the borders, which is one or two
rows for each week of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanwatch.functions import bin_number, numbered_bin_start
from spanwatch.model import ACCELEROMETERS, HUBS, sst_columns
from spanwatch.operators.timewindow import Window, time_bounds_multi, within

Tables = dict[str, DataFrame]

_WEEK_MINUTES = 7 * 1440
# 1970-01-01 is a Thursday, three days after the Monday of its week.
_MONDAY_MINUTES = 3 * 1440


def present_bins(tables: Tables, minutes: int) -> DataFrame:
    """Every (series, sensor, bin) with at least one value; each table is read once."""
    number = bin_number("datetime", minutes).alias("bin")
    wide = []
    if "accel_all" in tables:
        lengths = [F.coalesce(*[f"{a}_{axis}" for axis in "xyz"]).alias(a) for a in ACCELEROMETERS]
        wide.append((F.lit("acceleration"), tables["accel_all"].where("datetime IS NOT NULL").select(number, *lengths), ACCELEROMETERS))
    for hub in HUBS:
        if f"sst_{hub}" in tables:
            names = sst_columns(hub)
            series = F.when(F.col("sensor_id").startswith("S"), "strain").otherwise("temperature")
            wide.append((series, tables[f"sst_{hub}"].where("datetime IS NOT NULL").select(number, *names), names))
    found = None
    for series, frame, names in wide:
        counts = frame.groupBy("bin").agg(*[F.count(c).alias(c) for c in names])
        part = counts.unpivot(["bin"], names, "sensor_id", "n").where(F.col("n") > 0).select(series.alias("series"), "sensor_id", "bin")
        found = part if found is None else found.unionByName(part)
    for hub in HUBS:
        if f"fft_{hub}" in tables:
            spectra = tables[f"fft_{hub}"].where("datetime IS NOT NULL").select(F.lit("spectrum").alias("series"), "sensor_id", number)
            found = spectra.distinct() if found is None else found.unionByName(spectra.distinct())
    return found


def gaps_of(present: DataFrame, expected: DataFrame, low: Column, high: Column, minutes: int) -> DataFrame:
    """Runs of missing bins between the bins ``low`` and ``high``, both included.

    ``present`` has series, sensor_id and bin, each once; ``expected`` the series and
    sensors that should be there, so one without any value is one gap.
    """
    keys = ["series", "sensor_id"]
    week = F.floor((F.col("bin") * minutes + _MONDAY_MINUTES) / _WEEK_MINUTES)
    inside = W.partitionBy(*keys, "week").orderBy("bin")
    marked = present.where(F.col("bin").between(low, high)).withColumn("week", week).withColumns(
        {"before": F.lag("bin").over(inside), "after": F.lead("bin").over(inside)}
    )
    edge = F.col("before").isNull() | F.col("after").isNull()
    kept = marked.where(edge | (F.col("bin") - F.col("before") > 1)).withColumn("edge", edge)
    inner = kept.where(F.col("bin") - F.col("before") > 1).select(*keys, (F.col("before") + 1).alias("first"), (F.col("bin") - 1).alias("last"))
    # At most two rows of a sensor in each week.
    across = W.partitionBy(*keys).orderBy("bin")
    edges = kept.where("edge").withColumn("earlier", F.lag("bin").over(across))
    border = edges.where(F.col("before").isNull() & (F.col("bin") - F.col("earlier") > 1))
    border = border.select(*keys, (F.col("earlier") + 1).alias("first"), (F.col("bin") - 1).alias("last"))
    ends = edges.groupBy(*keys).agg(F.min("bin").alias("begin"), F.max("bin").alias("end"))
    bounds = expected.select(*keys, low.alias("low"), high.alias("high")).join(ends, keys, "left")
    outer = F.array(
        F.struct(F.col("low").alias("first"), F.coalesce(F.col("begin") - 1, F.col("high")).alias("last")),
        F.struct((F.col("end") + 1).alias("first"), F.col("high").alias("last")),
    )
    outside = bounds.select(*keys, F.explode(outer).alias("g")).select(*keys, "g.first", "g.last").where(F.col("first") <= F.col("last"))
    gaps = inner.unionByName(border).unionByName(outside)
    return gaps.select(
        *keys,
        numbered_bin_start("first", minutes).alias("gap_start"),
        numbered_bin_start(F.col("last") + 1, minutes).alias("gap_end"),
        (F.col("last") - F.col("first") + 1).alias("n_bins"),
    )


def coverage_gaps(sensors: DataFrame, tables: Tables, minutes: int = 60, window: Window | None = None) -> DataFrame:
    """Gaps of every expected series, from the earliest to the latest row of any table
    unless a window is given; ``gap_end`` is the start of the next bin with a value."""
    from spanwatch.operators.compare import expected_series

    low, high = window or (None, None)
    if low is None or high is None:
        bounds = time_bounds_multi(list(tables.values()))
        low = bounds.select("start_dt").scalar() if low is None else low
        high = bounds.select("end_dt").scalar() if high is None else high
    if window is not None:
        tables = {key: within(frame, window) for key, frame in tables.items()}
    present = present_bins(tables, minutes)
    return gaps_of(present, expected_series(sensors), bin_number(low, minutes), bin_number(high, minutes), minutes)
