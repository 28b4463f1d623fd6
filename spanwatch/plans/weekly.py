"""The tables behind every weekly report, for all weeks in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.functions import bin_number, iso_week, iso_year, numbered_bin_start, strain_mm_per_m
from spanwatch.model import ACCELEROMETERS, HUB_SENSORS, HUBS, THERMOMETERS
from spanwatch.operators.medians import median_of_rows
from spanwatch.operators.partials import accel_minute_of_partials, merged_bins, of_sensors
from spanwatch.operators.series import COLUMN_THERMOMETERS, SERIES, SLOTS, accel_minute, binned_series, strain_temp, temps_arch, temps_col
from spanwatch.operators.spectrum import THRESHOLD, fft_peak, fft_points, fft_union, frequency_counts, peak_of_counts
from spanwatch.operators.timewindow import FULL_WINDOW, weeks_between, within
from spanwatch.plans.ingest import ingest_week
from spanwatch.session import scratch_path
from spanwatch.sources.statistics import in_weeks, read_statistics
from spanwatch.sources.store import WEEK, read_tables, remove_path

Tables = dict[str, DataFrame]


def _weeks_of(frame: DataFrame, stamp: str) -> DataFrame:
    return frame.withColumn("iso_year", iso_year(stamp)).withColumn("iso_week", iso_week(stamp))


def weekly_tables(tables: Tables, minutes: int = 60, threshold: float = THRESHOLD) -> dict[str, DataFrame]:
    """Series of all weekly reports, each row with its ISO week.

    A report week runs from Monday 00:00 up to but not including the next Monday.
    """
    temps = {
        "temps_col": temps_col(tables, minutes, FULL_WINDOW),
        "temps_arch": temps_arch(tables, minutes, FULL_WINDOW),
    }
    result = {}
    for name, frame in temps.items():
        sensors = [c for c in frame.columns if c in THERMOMETERS]
        rows = frame.unpivot(["bin_start"], sensors, "sensor_id", "value")
        result[name] = _weeks_of(rows, "bin_start")
    strain = strain_temp(tables, minutes=minutes, window=FULL_WINDOW)
    result["strain_temp"] = _weeks_of(strain, "bin_start")
    minutely = accel_minute(tables["accel_all"], window=FULL_WINDOW)
    result["daily_v_grid"] = _weeks_of(minutely, "minute")
    spectra = _weeks_of(fft_union(tables).where(F.col("sensor_id").isin(ACCELEROMETERS)), "datetime")
    keys = [*WEEK, "sensor_id"]
    result["fft_kde"] = fft_peak(fft_points(spectra, threshold, keys), keys)
    return result


def _stage(frame: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, as it is read more than once."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _charts(frame: DataFrame, chart: Column, low: str, high: str) -> DataFrame:
    keys = [*WEEK, "sensor_id"]
    return (
        frame.groupBy(*keys)
        .agg(F.count(low).alias("n_points"), F.min(low).cast("double").alias("value_min"), F.max(high).cast("double").alias("value_max"))
        .withColumn("f_peak", F.lit(None).cast("double"))
        .withColumn("chart", chart)
    )


def weekly_backfill(
    tables: Tables, minutes: int = 60, threshold: float = THRESHOLD, partials: DataFrame | None = None, together: bool = False
) -> DataFrame:
    """One row per week, chart and sensor: points drawn, value range, peak frequency.

    This is the list of charts of every weekly report at once. Every table is read once:
    the rows of a hub are brought together by bin and written, as medians and means read
    them twice, and so are the counts of the frequencies of the spectra and the few rows
    of the charts of medians and means. A bin of many rows is split, so a task holds what a part of the rebalance holds, whatever the input.
    With ``partials`` temperatures and accelerations are merged from these instead.
    With ``together`` the tables are stored ones, whose files are sorted by time: the rows
    of a bin lie together already, and the tables are read twice instead of being written.
    """
    series = None
    for hub in HUBS:
        names = HUB_SENSORS[hub]["S"] + ([] if partials is not None else HUB_SENSORS[hub]["T"])
        wide = within(tables[f"sst_{hub}"], FULL_WINDOW).select(bin_number("datetime", minutes).alias("bin"), *names)
        part = binned_series(wide if together else _stage(wide.hint("rebalance", "bin"), f"binned-{hub}"), names)
        series = part if series is None else series.unionByName(part)
    slot = F.col("slot")
    names = F.array(*[F.lit(name) for name in SERIES])
    medians = median_of_rows(series, ["slot"], "v", "median", mean="mean", keep=lambda middle: _stage(middle, "middle-classes"))
    reduced = medians.select(
        F.get(names, F.pmod(slot, F.lit(SLOTS)).cast("int")).alias("sensor_id"),
        numbered_bin_start(F.floor(slot / SLOTS), minutes).alias("bin_start"),
        "median",
        "mean",
    )
    gauge = F.col("sensor_id").startswith("S")
    value = F.when(gauge, strain_mm_per_m(F.col("median"))).otherwise(F.col("mean"))
    reduced = _weeks_of(reduced.withColumn("value", value), "bin_start")
    temps = F.when(F.col("sensor_id").isin(COLUMN_THERMOMETERS), "temps_col").otherwise("temps_arch")
    charts = _stage(_charts(reduced, F.when(gauge, "strain_temp").otherwise(temps), "value", "value"), "charts")
    if partials is None:
        minutely = accel_minute(tables["accel_all"], window=FULL_WINDOW)
    else:
        minutely = accel_minute_of_partials(partials)
        bins = merged_bins(of_sensors(partials, THERMOMETERS), minutes)
        means = bins.select("sensor_id", "bin_start", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("value"))
        charts = charts.unionByName(_charts(_weeks_of(means, "bin_start"), temps, "value", "value"))
    charts = charts.unionByName(_charts(_weeks_of(minutely, "minute"), F.lit("daily_v_grid"), "v_min", "v_max"))
    spectra = _weeks_of(fft_union(tables).where(F.col("sensor_id").isin(ACCELEROMETERS)), "datetime")
    keys = [*WEEK, "sensor_id"]
    counts = _stage(frequency_counts(fft_points(spectra, threshold, keys), keys), "frequency-counts")
    peaks = peak_of_counts(counts, keys).select(
        *keys,
        "n_points",
        F.col("amp_min").cast("double").alias("value_min"),
        F.col("amp_max").cast("double").alias("value_max"),
        "f_peak",
        F.lit("fft_kde").alias("chart"),
    )
    drawn = charts.unionByName(peaks).where(F.col("n_points") > 0)
    return drawn.select(*WEEK, "chart", "sensor_id", "n_points", "value_min", "value_max", "f_peak")


def report_path(base: str) -> str:
    return f"{base}/report_rows"


def _spans(statistics: DataFrame) -> list[tuple[tuple[int, int], set[tuple[int, int]]]]:
    """Each filed week and the report weeks its rows lie in; the calendar bounds both."""
    whole = statistics.where(F.col("sensor_id").isNull() & F.col("first_dt").isNotNull())
    spans = whole.groupBy(*WEEK).agg(F.min("first_dt").alias("first_dt"), F.max("last_dt").alias("last_dt"))
    rows = spans.select(*WEEK, F.explode(weeks_between(F.col("first_dt"), F.col("last_dt"))).alias("d"))
    found: dict[tuple[int, int], set[tuple[int, int]]] = {}
    for r in rows.select(*WEEK, iso_year("d").alias("y"), iso_week("d").alias("w")).collect():
        found.setdefault((r.iso_year, r.iso_week), set()).add((r.y, r.w))
    return list(found.items())


def report_weeks(statistics: DataFrame, touched: list[tuple[int, int]] | None = None) -> set[tuple[int, int]]:
    """Report weeks that rows filed under the ``touched`` weeks lie in; a document's
    offset can move its time out of the week it is filed under."""
    return {week for filed, weeks in _spans(statistics) if touched is None or filed in touched for week in weeks}


def refresh_reports(spark: SparkSession, base: str, weeks: set[tuple[int, int]] | None = None, minutes: int = 60, threshold: float = THRESHOLD) -> None:
    """Replace the stored report rows of some weeks, or of all.

    Only filed weeks with rows in these are read, which the week statistics tell. The
    weeks to give after a merge are the report weeks of the weeks it touched, before it
    and after it.
    """
    statistics = read_statistics(spark, base)
    spans = _spans(statistics)
    wanted = report_weeks(statistics) if weeks is None else set(weeks)
    filed = [week for week, of in spans if of & wanted]
    listed = [y * 100 + w for y, w in wanted]
    tables = {}
    for key, frame in read_tables(spark, base, weeks=True).items():
        rows = in_weeks(frame, filed).where((iso_year("datetime") * 100 + iso_week("datetime")).isin(listed))
        tables[key] = rows.drop(*WEEK)
    charts = _stage(weekly_backfill(tables, minutes, threshold, together=True), "report")
    held = {tuple(r) for r in charts.select(*WEEK).distinct().collect()}
    (
        charts.repartition(*WEEK)
        .sortWithinPartitions(*WEEK, "chart", "sensor_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*WEEK)
        .parquet(report_path(base))
    )
    for year, week in wanted - held:
        remove_path(spark, f"{report_path(base)}/iso_year={year}/iso_week={week}")


def ingest_and_report(spark: SparkSession, documents: DataFrame, base: str, year: int, week: int) -> set[tuple[int, int]]:
    """Ingest one week and refresh the reports it changes; returns their weeks."""
    before = report_weeks(read_statistics(spark, base), [(year, week)])
    ingest_week(spark, documents, base, year, week)
    changed = before | report_weeks(read_statistics(spark, base), [(year, week)])
    refresh_reports(spark, base, changed)
    return changed


def read_reports(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(report_path(base)).select(*WEEK, "chart", "sensor_id", "n_points", "value_min", "value_max", "f_peak")
