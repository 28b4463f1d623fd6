"""Minute sums that wider bins, longer windows and reports are merged from.

For every sensor and minute: the rows with a value, their sum, the least and the
greatest. The mean of any bin of whole minutes is a sum of sums over a sum of counts, so
a month needs its minutes only, not its rows. Kept by week, they are replaced with the
weeks of their tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.functions import bin_start, resultant_sql
from spanwatch.model import ACCELEROMETERS, HUBS, sst_columns
from spanwatch.operators.series import GRID_DAYS
from spanwatch.operators.timewindow import Window, within
from spanwatch.sources.statistics import in_weeks
from spanwatch.sources.store import WEEK, no_rows, read_table, replace_weeks

SCHEMA = (
    "datetime timestamp_ntz, sensor_id string, n bigint, total double, least double, greatest double, "
    "table_key string, iso_year int, iso_week int"
)
KEYS = ["accel_all", *[f"sst_{hub}" for hub in HUBS]]
PARTITIONS = ["table_key", *WEEK]


def minute_partials(frame: DataFrame, key: str) -> DataFrame:
    """Partial results of one table, per sensor and minute (``datetime``).

    Accelerometers are reduced to their resultant. A minute with rows but without a
    value of a sensor has a row with ``n`` 0. Week columns of the table are kept: a
    minute filed under two weeks has a row in each.
    """
    filed = [c for c in WEEK if c in frame.columns]
    sensors = ACCELEROMETERS if key == "accel_all" else sst_columns(key.removeprefix("sst_"))
    value = {s: F.expr(resultant_sql(s)) if key == "accel_all" else F.col(s).cast("double") for s in sensors}
    timed = frame.where(F.col("datetime").isNotNull())
    rows = timed.select(*filed, bin_start("datetime", 1).alias("minute"), *[v.cast("double").alias(s) for s, v in value.items()])
    reduced = rows.groupBy(*filed, "minute").agg(
        *[F.struct(F.count(s).alias("n"), F.sum(s).alias("total"), F.min(s).alias("least"), F.max(s).alias("greatest")).alias(s) for s in sensors]
    )
    long = reduced.unpivot([*filed, "minute"], sensors, "sensor_id", "v")
    return long.select(F.col("minute").alias("datetime"), "sensor_id", "v.n", "v.total", "v.least", "v.greatest", F.lit(key).alias("table_key"), *filed)


def partials_path(base: str) -> str:
    return f"{base}/minute_partials"


def update_partials(spark: SparkSession, base: str, touched: list[tuple[int, int]] | None = None, keys: list[str] = KEYS) -> None:
    """Bring the partials of the ``touched`` weeks up to date, or of all; only rows of
    these weeks are read."""
    found, weeks = None, touched
    for key in keys:
        frame = read_table(spark, base, key, weeks=True)
        part = minute_partials(frame if touched is None else in_weeks(frame, touched), key)
        found = part if found is None else found.unionByName(part)
    if weeks is None:
        # The calendar bounds them.
        weeks = [tuple(r) for r in read_partials(spark, base).select(*WEEK).distinct().collect()]
    replace_weeks(found, partials_path(base), weeks, PARTITIONS)


def read_partials(spark: SparkSession, base: str) -> DataFrame:
    """The partials of all tables; empty if none were ever written."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    try:
        return spark.read.schema(SCHEMA).parquet(partials_path(base)).select(*names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, SCHEMA)


def of_sensors(partials: DataFrame, sensors: list[str], window: Window | None = None) -> DataFrame:
    """Partials of some sensors in a window that begins and ends with a minute."""
    wanted = partials.where(F.col("sensor_id").isin(sensors))
    return wanted if window is None else within(wanted, window)


def _whole_minutes(minutes: int) -> int:
    if int(minutes) < 1:
        raise ValueError("a bin holds whole minutes")
    return int(minutes)


def merged_bins(partials: DataFrame, minutes: int) -> DataFrame:
    """Partials of any wider bins, merged from those of the minutes."""
    grouped = partials.groupBy("sensor_id", bin_start("datetime", _whole_minutes(minutes)).alias("bin_start"))
    return grouped.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))


def _mean(n: Column, total: Column) -> Column:
    return F.when(n > 0, total / n)


def means_of_partials(partials: DataFrame, sensors: list[str], minutes: int = 60, window: Window | None = None) -> DataFrame:
    """Mean of each sensor per bin, one column each, as ``mean_series`` gives them."""
    rows = of_sensors(partials, sensors, window)
    own = {s: F.col("sensor_id") == s for s in sensors}
    means = [_mean(F.sum(F.when(o, F.col("n"))), F.sum(F.when(o, F.col("total")))).alias(s) for s, o in own.items()]
    return rows.groupBy(bin_start("datetime", _whole_minutes(minutes)).alias("bin_start")).agg(F.lit(minutes).alias("bin_minutes"), *means)


def accel_minute_of_partials(partials: DataFrame, sensors: list[str] = ACCELEROMETERS, window: Window | None = None) -> DataFrame:
    """Mean, least and greatest resultant per sensor and minute, as ``accel_minute``."""
    merged = merged_bins(of_sensors(partials, sensors, window), 1)
    return merged.select(
        "sensor_id", F.col("bin_start").alias("minute"), _mean(F.col("n"), F.col("total")).alias("v_avg"), F.col("least").alias("v_min"), F.col("greatest").alias("v_max")
    )


def day_range_of_partials(partials: DataFrame, latest: Column, sensors: list[str] = ACCELEROMETERS, days: int = GRID_DAYS) -> DataFrame:
    """Least and greatest resultant per sensor and day of the ``days`` up to ``latest``,
    as ``accel_day_range`` of the daily grid; days without rows have empty values."""
    last = latest.cast("date")
    rows = of_sensors(partials, sensors, (F.date_sub(last, days - 1).cast("timestamp_ntz"), None))
    daily = rows.groupBy("sensor_id", F.col("datetime").cast("date").alias("day")).agg(F.min("least").alias("y_min"), F.max("greatest").alias("y_max"))
    named = F.explode(F.array(*[F.lit(s) for s in sensors])).alias("sensor_id")
    spine = partials.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("day")).select("day", named)
    return spine.join(daily, ["sensor_id", "day"], "left")
