"""Approximate medians from sketches that merge, beside the exact ones.

A quantile sketch (KLL) of every sensor and minute answers for any bin of whole minutes
without the rows: sketches of parts merge to the sketch of the whole. A quantile may be
off by some ranks, a share of the values that depends on the size of the sketch alone;
up to that size it is exact. The exact form in ``medians.py`` stays the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.functions import bin_start

SIZE = 200


def rank_error(size: int = SIZE) -> float:
    """Share of the values by which the rank of a quantile may be off, at a confidence
    of 99 percent."""
    return 2.296 / size**0.9723


def minute_sketches(frame: DataFrame, columns: list[str], size: int = SIZE) -> DataFrame:
    """sensor_id, datetime (the minute), n and sketch of the values, one pass over the
    rows; minutes without a value of a sensor have no row."""
    rows = frame.where(F.col("datetime").isNotNull()).select(bin_start("datetime", 1).alias("datetime"), *columns)
    # Not-a-number has no rank.
    values = {c: F.when(~F.isnan(c), F.col(c).cast("float")) for c in columns}
    reduced = rows.groupBy("datetime").agg(
        *[F.struct(F.count(v).alias("n"), F.kll_sketch_agg_float(v, F.lit(size)).alias("sketch")).alias(c) for c, v in values.items()]
    )
    long = reduced.unpivot(["datetime"], columns, "sensor_id", "v")
    return long.select("sensor_id", "datetime", "v.n", "v.sketch").where(F.col("n") > 0)


def merged_medians(sketches: DataFrame, minutes: int = 60, size: int = SIZE) -> DataFrame:
    """Approximate median per sensor and bin, merged from the sketches of its minutes."""
    if int(minutes) < 1:
        raise ValueError("a bin holds whole minutes")
    grouped = sketches.groupBy("sensor_id", bin_start("datetime", minutes).alias("bin_start"))
    merged = grouped.agg(F.sum("n").alias("n"), F.kll_merge_agg_float("sketch", F.lit(size)).alias("sketch"))
    return merged.select("sensor_id", "bin_start", "n", F.kll_sketch_get_quantile_float("sketch", F.lit(0.5).cast("double")).alias("median"))
