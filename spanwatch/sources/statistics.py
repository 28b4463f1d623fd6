"""What every weekly table holds in each week, as a small ordinary table beside them.

One row per table and week, and one per sensor with values in it: rows, first and last
time, and a digest of the rows that does not depend on their order. Windows, bounds,
coverage and comparisons read these rows instead of the weekly tables. They are written
with the weeks; a week that is emptied has none.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.model import ACCELEROMETERS, TABLE_KEYS, hub_of, sst_columns
from spanwatch.session import scratch_path
from spanwatch.sources.store import WEEK, no_rows, read_table, remove_path

SCHEMA = (
    "table_key string, iso_year int, iso_week int, sensor_id string, n_rows bigint, "
    "first_dt timestamp_ntz, last_dt timestamp_ntz, digest decimal(38,0)"
)
PARTITIONS = ["table_key", "iso_year"]


def statistics_path(base: str) -> str:
    return f"{base}/week_statistics"


def rows_digest(columns: list[str]) -> Column:
    """Digest of a group's rows in any order, repeated rows included.

    A hash passes over nulls, so which columns are null is hashed as well.
    """
    nulls = F.array(*[F.col(c).isNull() for c in columns])
    return F.sum(F.xxhash64(*columns, nulls).cast("decimal(20,0)")).cast("decimal(38,0)")


def _present(key: str) -> dict[str, Column]:
    """Sensors of a wide table, and what is not null where one has a value."""
    if key == "accel_all":
        return {a: F.coalesce(*[F.col(f"{a}_{axis}") for axis in "xyz"]) for a in ACCELEROMETERS}
    return {c: F.col(c) for c in sst_columns(key.removeprefix("sst_"))}


def week_statistics(rows: DataFrame, key: str) -> DataFrame:
    """Statistics of one table, whose rows carry their week; one pass over the rows.

    ``sensor_id`` is null in the row of the whole table, and sensors have no digest.
    Untimed rows count, but have no part in the times.
    """
    values = [c for c in rows.columns if c not in WEEK and c != "hub"]
    stamp = F.col("datetime")
    whole = [F.count("*").alias("n_rows"), F.min(stamp).alias("first_dt"), F.max(stamp).alias("last_dt"), rows_digest(values).alias("digest")]
    if key.startswith("fft_"):
        # Reduced per sensor first; the table's row is formed of these few rows.
        sensors = rows.groupBy(*WEEK, "sensor_id").agg(*whole)
        both = sensors.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("all"))
        named = both.withColumn("sensor_id", F.when(~F.col("all"), F.col("sensor_id"))).where(F.col("all") | F.col("sensor_id").isNotNull())
        found = named.groupBy(*WEEK, "sensor_id", "all").agg(
            F.sum("n_rows").alias("n_rows"), F.min("first_dt").alias("first_dt"), F.max("last_dt").alias("last_dt"), F.sum("digest").alias("digest")
        )
        found = found.withColumn("digest", F.when(F.col("all"), F.col("digest")))
    else:
        parts = [
            F.struct(F.count(p).alias("n_rows"), F.min(F.when(p.isNotNull(), stamp)).alias("first_dt"), F.max(F.when(p.isNotNull(), stamp)).alias("last_dt")).alias(name)
            for name, p in _present(key).items()
        ]
        wide = rows.groupBy(*WEEK).agg(F.struct(*whole).alias("table"), *parts)
        entries = [F.struct(F.lit(None).cast("string").alias("sensor_id"), "table.n_rows", "table.first_dt", "table.last_dt", "table.digest")]
        none = F.lit(None).cast("decimal(38,0)").alias("digest")
        entries += [F.struct(F.lit(n).alias("sensor_id"), f"{n}.n_rows", f"{n}.first_dt", f"{n}.last_dt", none) for n in _present(key)]
        found = wide.select(*WEEK, F.explode(F.array(*entries)).alias("s")).select(*WEEK, "s.*").where("sensor_id is null or n_rows > 0")
    return found.select(
        F.lit(key).alias("table_key"), *WEEK, "sensor_id", "n_rows", "first_dt", "last_dt", F.col("digest").cast("decimal(38,0)").alias("digest")
    )


def read_statistics(spark: SparkSession, base: str) -> DataFrame:
    """The statistics of all tables below ``base``; empty if none were ever written."""
    try:
        return spark.read.schema(SCHEMA).parquet(statistics_path(base)).select(*[f.split()[0] for f in SCHEMA.split(", ")])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, SCHEMA)


def in_weeks(frame: DataFrame, weeks: list[tuple[int, int]]) -> DataFrame:
    """Rows filed under the given weeks, a list the calendar bounds; other weeks of a
    stored table are not opened."""
    number = F.col("iso_year") * 100 + F.col("iso_week")
    return frame.where(number.isin([y * 100 + w for y, w in weeks]))


def update_statistics(spark: SparkSession, base: str, touched: list[tuple[int, int]] | None = None, keys: list[str] = TABLE_KEYS) -> None:
    """Bring the statistics of the ``touched`` weeks up to date, or of all weeks.

    Only these weeks are read. A year's statistics are one small file per table; it is
    written to the side first, as it is read from the file it replaces.
    """
    known = read_statistics(spark, base).where(F.col("table_key").isin(keys))
    fresh = None
    for key in keys:
        frame = read_table(spark, base, key, weeks=True)
        part = week_statistics(frame if touched is None else in_weeks(frame, touched), key)
        fresh = part if fresh is None else fresh.unionByName(part)
    years = None
    if touched is not None:
        years = sorted({y for y, _ in touched})
        number = F.col("iso_year") * 100 + F.col("iso_week")
        other = known.where(F.col("iso_year").isin(years) & ~number.isin([y * 100 + w for y, w in touched]))
        fresh = fresh.unionByName(other)
    side = scratch_path(spark, "statistics")
    try:
        fresh.write.parquet(side)
        after = spark.read.schema(SCHEMA).parquet(side)
        held = {tuple(r) for r in after.select(*PARTITIONS).distinct().collect()}
        before = known if years is None else known.where(F.col("iso_year").isin(years))
        gone = {tuple(r) for r in before.select(*PARTITIONS).distinct().collect()} - held
        after.repartition(*PARTITIONS).sortWithinPartitions("iso_week", "sensor_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*PARTITIONS).parquet(statistics_path(base))
        for key, year in gone:
            remove_path(spark, f"{statistics_path(base)}/table_key={key}/iso_year={year}")
    finally:
        remove_path(spark, side)


def of_tables(statistics: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of whole tables."""
    return statistics.where(F.col("table_key").isin(keys) & F.col("sensor_id").isNull())


def latest_time(statistics: DataFrame, keys: list[str]) -> Column:
    """Latest time in any of the tables, as a scalar subquery over the statistics."""
    return of_tables(statistics, keys).agg(F.max("last_dt")).scalar()


def bounds_of(statistics: DataFrame, keys: list[str] = TABLE_KEYS) -> DataFrame:
    """Earliest and latest time per table, as ``time_bounds`` gives them."""
    bounds = of_tables(statistics, keys).groupBy("table_key").agg(F.min("first_dt").alias("start_dt"), F.max("last_dt").alias("end_dt"))
    every = statistics.sparkSession.createDataFrame([(k,) for k in keys], "table_key string")
    return every.join(bounds, "table_key", "left")


def latest_spectra(statistics: DataFrame, sensors: list[str] = ACCELEROMETERS) -> DataFrame:
    """Earliest and latest spectrum per sensor, as ``fft_bounds`` gives them."""
    keys = sorted({f"fft_{hub_of(a)}" for a in sensors})
    wanted = statistics.where(F.col("table_key").isin(keys) & F.col("sensor_id").isin(sensors))
    return wanted.groupBy("sensor_id").agg(F.min("first_dt").alias("start_dt"), F.max("last_dt").alias("end_dt"))


def rows_by_week(statistics: DataFrame) -> DataFrame:
    """Row count of every table and week that has rows."""
    return statistics.where(F.col("sensor_id").isNull()).select("table_key", *WEEK, "n_rows")
