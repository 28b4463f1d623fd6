"""Spectra: points above a threshold, their density over frequency, the peak."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.functions import at_or_above, bin_start
from spanwatch.model import ACCELEROMETERS, HUBS
from spanwatch.operators.timewindow import as_stamp, day_span, within

THRESHOLD = 0.08
GRID_POINTS = 500
SLICES = 32
# Points of a group and the span of its line, carried along with its density.
SPAN = ["n_points", "amp_min", "amp_max"]


def fft_union(tables: dict[str, DataFrame]) -> DataFrame:
    """The four hubs' spectra as one table with a ``hub`` column."""
    union = None
    for hub in HUBS:
        part = tables[f"fft_{hub}"].withColumn("hub", F.lit(hub))
        union = part if union is None else union.unionByName(part)
    return union


def fft_bounds(fft: DataFrame, sensors: list[str] = ACCELEROMETERS) -> DataFrame:
    """Earliest and latest spectrum per sensor."""
    wanted = fft.where(F.col("sensor_id").isin(sensors))
    return wanted.groupBy("sensor_id").agg(
        F.min("datetime").alias("start_dt"), F.max("datetime").alias("end_dt")
    )


def fft_within(
    fft: DataFrame, sensors: list[str] = ACCELEROMETERS, start=None, end=None, days: int = 7, bounds: DataFrame | None = None
) -> DataFrame:
    """Spectra of the sensors in a closed window, by default each sensor's last days.

    ``bounds`` are the sensors' earliest and latest times where they are known, as from
    the week statistics of stored tables.
    """
    wanted = fft.where(F.col("sensor_id").isin(sensors))
    if end is not None:
        low = as_stamp(start) if start is not None else as_stamp(end) - day_span(days)
        return within(wanted, (low, as_stamp(end)))
    if start is not None:
        return within(wanted, (as_stamp(start), None))
    # At most one row per listed sensor, so the broadcast has a fixed size.
    limits = (fft_bounds(fft, sensors) if bounds is None else bounds).select(
        "sensor_id", (F.col("end_dt") - day_span(days)).alias("low")
    )
    # No sensor's window begins before the earliest one: that bound reaches the scan.
    recent = within(wanted, (limits.agg(F.min("low")).scalar(), None))
    return recent.join(F.broadcast(limits), "sensor_id").where(F.col("datetime") >= F.col("low")).drop("low")


def fft_points(spectra: DataFrame, threshold: float = THRESHOLD, keep: list[str] = ["sensor_id"]) -> DataFrame:
    """Points (frequency, amplitude) whose amplitude reaches the threshold.

    Only amplitudes are unnested; a frequency is looked up by position for the
    points that stay, null if its list is shorter. Frequencies beyond the last
    amplitude have no amplitude and never reach the threshold.
    """
    unnested = spectra.select(*keep, "fft_freqs", F.posexplode("fft_amps").alias("at", "amp"))
    reached = unnested.where(at_or_above(F.col("amp"), threshold))
    return reached.select(*keep, F.get("fft_freqs", F.col("at")).alias("freq"), "amp")


def fft_main_series(fft: DataFrame, minutes: int = 60) -> DataFrame:
    """Stored main frequency and amplitude per sensor and bin."""
    grouped = fft.groupBy("sensor_id", bin_start("datetime", minutes).alias("bin_start"))
    return grouped.agg(
        F.lit(minutes).alias("bin_minutes"),
        F.count("*").alias("n_spectra"),
        *[
            fn(f"fft_main_{c}").alias(f"{c}_{tag}")
            for c in "fa"
            for tag, fn in [("avg", F.avg), ("min", F.min), ("max", F.max)]
        ],
    )


def _in_slices(frame: DataFrame, slices: int) -> DataFrame:
    """One copy of each (group) row per slice, to meet the sliced frequency rows."""
    return frame.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))


def frequency_counts(points: DataFrame, keys: list[str], slices: int = SLICES) -> DataFrame:
    """Points per group and frequency, spread over slices of each group.

    Instruments report a fixed set of frequencies, so this is small; where they do
    not, the slices still keep a group from landing in one task.
    """
    counted = points.groupBy(*keys, "freq").agg(
        F.count("*").alias("n"),
        F.min("amp").alias("amp_min"),
        F.max("amp").alias("amp_max"),
    )
    return counted.withColumn("f", F.col("freq").cast("double")).withColumn(
        "slice", F.pmod(F.xxhash64("freq"), F.lit(slices)).cast("int")
    )


def _bandwidths(counts: DataFrame, keys: list[str], slices: int) -> DataFrame:
    """Per group: size, range and kernel width by Scott's rule.

    Groups with fewer than two points or a single frequency have no density and
    are left out. The squares are taken around the mean, which a one-pass sum of
    squares would lose for nearly equal frequencies.
    """
    n, f = F.col("n"), F.col("f")
    usable = f.isNotNull() & ~F.isnan(f)
    own, moment = F.when(usable, n), F.when(usable, n * f)
    centre = counts.groupBy(*keys).agg(
        F.sum(own).alias("total"),
        (F.sum(moment) / F.sum(own)).alias("mean"),
        F.min(F.when(usable, f)).alias("low"),
        F.max(F.when(usable, f)).alias("high"),
        F.sum(n).alias("n_points"),
        F.min("amp_min").alias("amp_min"),
        F.max("amp_max").alias("amp_max"),
    )
    centre = centre.where((F.col("total") >= 2) & (F.col("low") < F.col("high")))
    away = counts.where(usable).select(*keys, "slice", "f", "n").join(
        _in_slices(centre, slices), [*keys, "slice"]
    )
    off = f - F.col("mean")
    squares = away.groupBy(*keys, "total", "low", "high", *SPAN).agg(F.sum(n * off * off).alias("squares"))
    spread = F.sqrt(F.col("squares") / (F.col("total") - 1))
    width = spread * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    return squares.select(*keys, "total", "low", "high", *SPAN, width.alias("h"))


def _density(counts: DataFrame, keys: list[str], grid_points: int, slices: int) -> DataFrame:
    stats = _in_slices(_bandwidths(counts, keys, slices), slices)
    counts = counts.where(F.col("f").isNotNull() & ~F.isnan("f"))
    last = grid_points - 1
    step = (F.col("high") - F.col("low")) / F.lit(float(last))
    x = F.when(F.col("k") == last, F.col("high")).otherwise(F.col("low") + F.col("k") * step)
    z = (F.col("x") - F.col("f")) / F.col("h")
    kernel = F.col("n") * F.exp(F.lit(-0.5) * z * z)
    norm = F.col("total") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return (
        counts.select(*keys, "slice", "f", "n")
        .join(stats, [*keys, "slice"])
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(last))))
        .withColumn("x", x)
        .groupBy(*keys, "k", "x", "total", "h", *SPAN)
        .agg(F.sum(kernel).alias("s"))
        .select(*keys, "k", "x", (F.col("s") / norm).alias("density"), *SPAN)
    )


def fft_kde(
    points: DataFrame,
    keys: list[str] = ["sensor_id"],
    grid_points: int = GRID_POINTS,
    slices: int = SLICES,
) -> DataFrame:
    """Gaussian kernel density of the frequencies on an even grid, per group.

    The cost is distinct frequencies times grid points, not points times grid
    points. Partial sums are formed before the shuffle, so at most one row per task
    and grid point is sent.
    """
    return _density(frequency_counts(points, keys, slices), keys, grid_points, slices).drop(*SPAN)


def fft_peak(
    points: DataFrame,
    keys: list[str] = ["sensor_id"],
    grid_points: int = GRID_POINTS,
    slices: int = SLICES,
) -> DataFrame:
    """Frequency of the greatest density per group, with the span of its line.

    Of equal densities the lowest frequency wins.
    """
    return peak_of_counts(frequency_counts(points, keys, slices), keys, grid_points, slices)


def peak_of_counts(counts: DataFrame, keys: list[str], grid_points: int = GRID_POINTS, slices: int = SLICES) -> DataFrame:
    """As :func:`fft_peak`, from the frequency counts."""
    density = _density(counts, keys, grid_points, slices)
    return density.groupBy(*keys).agg(
        F.max_by("x", F.struct("density", (-F.col("k")).alias("first"))).alias("f_peak"),
        F.max("density").alias("density"),
        *[F.max(c).alias(c) for c in SPAN],
    )


# Bins of the approximate density, and the kernel widths after which it is cut off.
DENSITY_BINS = 4096
KERNEL_REACH = 6.0


def fft_kde_binned(
    points: DataFrame,
    keys: list[str] = ["sensor_id"],
    grid_points: int = GRID_POINTS,
    bins: int = DENSITY_BINS,
    reach: float = KERNEL_REACH,
    slices: int = SLICES,
) -> DataFrame:
    """Approximate density on the same grid as :func:`fft_kde`, with its error bound.

    For instruments that report continuous frequencies: each point is dealt to the two
    of ``bins`` even places around it by nearness, and the kernel is cut off after
    ``reach`` widths, so the cost after one pass over the points does not depend on how
    many frequencies differ. ``bound`` is what the density may be off by: the curvature
    of the kernel times an eighth of the squared bin width, and the kernel's height
    where it is cut off. Groups without a density are left out as there.
    """
    f = F.col("freq").cast("double")
    usable = points.where(F.col("freq").isNotNull() & ~F.isnan("freq")).select(*keys, f.alias("f"))
    spread = usable.groupBy(*keys).agg(F.count("*").alias("total"), F.min("f").alias("low"), F.max("f").alias("high"), F.stddev_samp("f").alias("s"))
    spread = spread.where((F.col("total") >= 2) & (F.col("low") < F.col("high")))
    stats = spread.select(*keys, "total", "low", "high", (F.col("s") * F.pow(F.col("total").cast("double"), F.lit(-0.2))).alias("h"))
    sliced = usable.withColumn("slice", F.pmod(F.xxhash64("f"), F.lit(slices)).cast("int"))
    width = (F.col("high") - F.col("low")) / (bins - 1)
    met = sliced.join(_in_slices(stats, slices), [*keys, "slice"]).withColumn("at", (F.col("f") - F.col("low")) / width)
    place = F.least(F.floor("at"), F.lit(bins - 2))
    two = F.array(
        F.struct(place.alias("bin"), (place + 1 - F.col("at")).alias("weight")), F.struct((place + 1).alias("bin"), (F.col("at") - place).alias("weight"))
    )
    dealt = met.select(*keys, "total", "low", "high", "h", F.explode(two).alias("b"))
    binned = dealt.groupBy(*keys, "total", "low", "high", "h", "b.bin").agg(F.sum("b.weight").alias("weight")).where(F.col("weight") > 0)

    last = grid_points - 1
    step = (F.col("high") - F.col("low")) / F.lit(float(last))
    centre = F.col("low") + F.col("bin") * width
    away = F.lit(float(reach)) * F.col("h")
    first_k = F.greatest(F.lit(0), F.ceil((centre - away - F.col("low")) / step)).cast("int")
    last_k = F.least(F.lit(last), F.floor((centre + away - F.col("low")) / step)).cast("int")
    x = F.when(F.col("k") == last, F.col("high")).otherwise(F.col("low") + F.col("k") * step)
    z = (F.col("x") - F.col("centre")) / F.col("h")
    root = math.sqrt(2 * math.pi)
    near = binned.withColumn("centre", centre).where(first_k <= last_k).withColumn("k", F.explode(F.sequence(first_k, last_k))).withColumn("x", x)
    sums = near.groupBy(*keys, "k").agg(F.sum(F.col("weight") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    grid = stats.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(last)))).withColumn("x", x)
    bound = width * width / (8 * root * F.pow("h", F.lit(3.0))) + math.exp(-0.5 * reach * reach) / (root * F.col("h"))
    density = F.coalesce(F.col("s"), F.lit(0.0)) / (F.col("total") * F.col("h") * root)
    return grid.join(sums, [*keys, "k"], "left").select(*keys, "k", "x", density.alias("density"), bound.alias("bound"))
