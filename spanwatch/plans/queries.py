"""Every operator as a query over the given tables.

Each entry takes a session and the folder of the tables. Means are rounded, since
the order of summation is not fixed; all other values are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch import functions as fn
from spanwatch.model import ACCELEROMETERS, HUBS, TABLE_KEYS, sst_columns
from spanwatch.operators import compare, flatten, gaps, partials, registry, series, sketches, spectrum, timewindow
from spanwatch.plans import ingest, standin, weekly
from spanwatch.session import scratch_path
from spanwatch.sources import documents, statistics, store
from spanwatch.streaming import bins, late
from spanwatch.streaming import ingest as streamed

DIGITS = 6
SST = [f"sst_{hub}" for hub in HUBS]
FFT = [f"fft_{hub}" for hub in HUBS]
ARCH = SST[1:]
GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(frame: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


# Sources and sinks


@query
def ingest_range_scan(spark, sf_dir):
    lines = standin.plain_lines(spark, sf_dir)
    return documents.scan_week(lines, 2024, 2)


@query
def export_day_jsonl(spark, sf_dir):
    path = scratch_path(spark, "days")
    documents.export_day_slices(standin.plain_lines(spark, sf_dir), path)
    written = spark.read.text(path)
    return written.select("slice", "value")


@query
def export_json_lines(spark, sf_dir):
    rows = standin.events(spark, sf_dir)
    fraction = F.when(F.col("event_type") != "error", (F.col("k") / 4).cast("float"))
    return documents.as_json_lines(rows.select("event_id", F.col("datetime").alias("at"), fraction.alias("quarter")))


@query
def fetch_one_day(spark, sf_dir):
    path = scratch_path(spark, "days")
    documents.export_day_slices(standin.plain_lines(spark, sf_dir), path)
    return documents.read_day_slices(spark, path, date(2024, 1, 9))


@query
def export_day_counts(spark, sf_dir):
    return documents.count_day_slices(standin.plain_lines(spark, sf_dir))


@query
def sample_document(spark, sf_dir):
    return documents.sample_documents(standin.plain_lines(spark, sf_dir), 1, order="value")


@query
def weekly_write(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    store.append_chunks(store.with_week(standin.sst(spark, sf_dir, "hub1")), path)
    return store.read_chunks(spark, path)


@query
def weekly_merge(spark, sf_dir):
    base = scratch_path(spark, "weekly")
    chunks = f"{base}/chunks"
    # Chunks of errors and clicks come from a version of the logger without S14.
    events = standin.events(spark, sf_dir)
    early = F.col("event_type").isin("error", "click")
    rows = store.with_week(standin.sst_of(events.where(early), "hub2"))
    store.append_chunks(rows.drop("S14"), chunks)
    store.append_chunks(store.with_week(standin.sst_of(events.where(~early), "hub2")), chunks)
    final = store.table_path(base, "sst_hub2")
    store.merge_weeks(store.read_chunks(spark, chunks), final)
    store.merge_weeks(store.read_chunks(spark, chunks), final)
    return store.read_table(spark, base, "sst_hub2", weeks=True)


@query
def weekly_merge_empty(spark, sf_dir):
    tables = standin.tables(spark, sf_dir)
    return store.rows_per_week(tables, timewindow.week_spine(list(tables.values())))


@query
def union_append(spark, sf_dir):
    old, new = standin.versions(spark, sf_dir)
    return store.union_append(old, new)


@query
def union_by_name(spark, sf_dir):
    return store.union_by_name(*[standin.sst(spark, sf_dir, hub) for hub in HUBS])


@query
def file_inventory(spark, sf_dir):
    inventory = store.file_inventory(spark, *[f"{sf_dir}/{name}.parquet" for name in GIVEN])
    return inventory.select("file", "n_rows")


@query
def register_views(spark, sf_dir):
    views = store.register_views(standin.tables(spark, sf_dir), prefix="spanwatch_")
    parts = [
        f"SELECT '{v.removeprefix('spanwatch_')}' AS table_key, count(*) AS n_rows, "
        f"min(datetime) AS first_dt, max(datetime) AS last_dt FROM {v}"
        for v in views
    ]
    return spark.sql(" UNION ALL ".join(parts))


@query
def describe_tables(spark, sf_dir):
    return store.describe_tables(standin.tables(spark, sf_dir))


# Extraction


@query
def flatten_accel(spark, sf_dir):
    lines = standin.reading_documents(spark, sf_dir)
    return flatten.flatten(lines, ["accel_all"])["accel_all"]


@query
def flatten_sst(spark, sf_dir):
    parsed = flatten.parse_documents(standin.reading_documents(spark, sf_dir), HUBS)
    return flatten.hub_rows(parsed)


@query
def flatten_fft(spark, sf_dir):
    lines = standin.spectrum_documents(spark, sf_dir)
    spectra = flatten.fft_rows(flatten.parse_documents(lines, ["fft"]))
    return spectra.select(
        "datetime",
        "hub",
        "sensor_id",
        "fft_main_f",
        "fft_main_a",
        F.size("fft_freqs").alias("n_freqs"),
        F.size("fft_amps").alias("n_amps"),
    )


@query
def flatten_fft_arrays(spark, sf_dir):
    lines = standin.spectrum_documents(spark, sf_dir)
    spectra = flatten.fft_rows(flatten.parse_documents(lines, ["fft"]))
    return spectra.select(
        "datetime", "sensor_id", "fft_freqs", F.posexplode("fft_amps").alias("at", "amp")
    ).select("datetime", "sensor_id", "at", F.get("fft_freqs", "at").alias("freq"), "amp")


@query
def safe_float(spark, sf_dir):
    k = F.col("k").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.col("value").cast("string"))
        .when(kind == "signup", F.concat(F.lit('" '), k, F.lit('.5 "')))
        .when(kind == "click", F.lit("true"))
        .when(kind == "view", F.concat(F.lit('"'), k, F.lit('f"')))
        .otherwise(F.concat(F.lit('"1_'), F.lpad(k, 3, "0"), F.lit('"')))
    )
    rows = standin.events(spark, sf_dir).select(
        "event_id",
        F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "variant").alias("doc"),
    )
    return rows.select("event_id", fn.document_float("doc", "$.v").alias("reading"))


@query
def parse_timestamp(spark, sf_dir):
    text = standin.iso_text(F.col("datetime"))
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", F.concat(text, F.lit("+02:00")))
        .when(kind == "signup", F.concat(F.translate(text, "T", " "), F.lit("Z")))
        .when(kind == "click", F.substring(text, 1, 10))
        .when(kind == "view", F.concat(F.substring(text, 1, 16), F.lit("-05:30")))
        .otherwise(F.concat(F.lit("at "), text))
    )
    rows = standin.events(spark, sf_dir).select("event_id", written.alias("text"))
    return rows.select("event_id", "text", fn.parse_iso("text").alias("datetime"))


@query
def ingest_quarantine(spark, sf_dir):
    lines = standin.faulty_lines(spark, sf_dir)
    return flatten.quarantine(flatten.parse_documents(lines, []))


def _stored(spark, base):
    """Rows, first time and a sum over every stored weekly table."""
    result = None
    for key, frame in store.read_tables(spark, base).items():
        column = {"a": "A30_t", "f": "fft_main_a", "s": frame.columns[1]}[key[0]]
        row = frame.agg(
            F.lit(key).alias("table_key"),
            F.count("*").alias("n_rows"),
            F.min("datetime").alias("first_dt"),
            F.max("datetime").alias("last_dt"),
            F.round(F.sum(F.col(column).cast("double")), 3).alias("total"),
        )
        result = row if result is None else result.unionByName(row)
    return result


def _all_documents(spark, sf_dir):
    return standin.reading_documents(spark, sf_dir).unionAll(standin.spectrum_documents(spark, sf_dir))


@query
def ingest_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "ingested")
    received = scratch_path(spark, "received")
    _all_documents(spark, sf_dir).write.text(received)
    for _ in range(2):
        ingest.ingest(spark, documents.read_documents(spark, received), base)
    return _stored(spark, base)


@query
def ingest_week_quarantine(spark, sf_dir):
    base = scratch_path(spark, "ingested")
    for _ in range(2):
        ingest.ingest_week(spark, standin.faulty_lines(spark, sf_dir), base, 2024, 2)
    rows = store.read_table(spark, base, "sst_hub2").select(F.lit("row").alias("kind"), F.col("S7").cast("string").alias("detail"))
    faults = spark.read.parquet(f"{base}/quarantine").select(F.col("reason").alias("kind"), F.coalesce("line", "stamp").alias("detail"))
    return rows.unionByName(faults)


@query
def stream_ingest(spark, sf_dir):
    """All documents as files that a stream picks up and a merge brings into the tables."""
    base = scratch_path(spark, "streamed")
    _all_documents(spark, sf_dir).write.text(f"{base}/in")
    for _ in range(2):
        streamed.stream_ingest(spark, f"{base}/in", f"{base}/chunks", f"{base}/check").awaitTermination()
        streamed.merge_chunks(spark, f"{base}/chunks", f"{base}/out")
    return _stored(spark, f"{base}/out")


@query
def stream_ingest_repeats(spark, sf_dir):
    """As ``stream_ingest`` with every file delivered twice, in batches of their own.

    The files are compressed, as all of both deliveries lie there to the end."""
    base = scratch_path(spark, "streamed")
    for delivery in range(2):
        lines = documents.read_documents(spark, f"{base}/in") if delivery else _all_documents(spark, sf_dir)
        lines.write.mode("append").option("compression", "gzip").text(f"{base}/in")
        stream = streamed.stream_ingest(spark, f"{base}/in", f"{base}/chunks", f"{base}/check", repeats_within="14 days")
        stream.awaitTermination()
        streamed.merge_chunks(spark, f"{base}/chunks", f"{base}/out")
    return _stored(spark, f"{base}/out")


def _received(spark, sf_dir):
    """Events as a stream of three files: those of error come after all others, and one
    row, years later, closes the bins."""
    base = scratch_path(spark, "received")
    events = standin.events(spark, sf_dir)
    error = F.col("event_type") == "error"
    rows = standin.accel_of(events.where(~error))
    closing = spark.range(1).select(F.lit("2030-01-01").cast("timestamp_ntz").alias("datetime"), *[F.lit(0.0).cast("float").alias(c) for c in rows.columns[1:]])
    for part in (rows, standin.accel_of(events.where(error)), closing):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    late.stream_receive(stream, base, f"{base}/check").awaitTermination()
    return base, rows.schema


@query
def stream_accel_minute(spark, sf_dir):
    """Minute resultants of a stream, as far as the watermark closed them."""
    base, schema = _received(spark, sf_dir)
    minutes = bins.stream_accel_minute(late.on_time(spark, base, schema))
    sink = minutes.writeStream.format("parquet").option("checkpointLocation", f"{base}/check-bins").option("path", f"{base}/out")
    sink.trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.read.parquet(f"{base}/out"), "v_avg")


@query
def stream_late_rows(spark, sf_dir):
    """The rows of the same stream that came after their bin was closed."""
    base, schema = _received(spark, sf_dir)
    return late.late_rows(spark, base, schema)


@query
def stream_bins(spark, sf_dir):
    """Hourly means of a stream of the events, as far as the watermark closed them."""
    base = scratch_path(spark, "bins")
    rows = standin.sst(spark, sf_dir, "hub1").select("datetime", "T4", "T5", "T6")
    rows.write.parquet(f"{base}/in")
    # One more row, years later, closes all bins before it.
    closing = spark.range(1).select(F.lit("2030-01-01").cast("timestamp_ntz").alias("datetime"), *[F.lit(0.0).cast("float").alias(c) for c in ("T4", "T5", "T6")])
    closing.write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    means = bins.stream_means(stream, ["T4", "T5", "T6"], 60)
    sink = means.writeStream.format("parquet").option("checkpointLocation", f"{base}/check").option("path", f"{base}/out")
    sink.trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.read.parquet(f"{base}/out"), "T4", "T5", "T6")


# Week statistics of stored tables


@query
def week_statistics(spark, sf_dir):
    """Statistics of all stored tables after one week of one table was emptied."""
    base = scratch_path(spark, "weekly")
    standin.store(spark, sf_dir, base)
    none = store.with_week(store.empty_table(spark, "sst_hub1"))
    store.replace_weeks(none, store.table_path(base, "sst_hub1"), [(2024, 2)])
    statistics.update_statistics(spark, base, [(2024, 2)])
    return statistics.read_statistics(spark, base).drop("digest")


@query
def stored_last_7_days(spark, sf_dir):
    base = scratch_path(spark, "weekly")
    standin.store(spark, sf_dir, base, ["sst_hub1"])
    latest = statistics.latest_time(statistics.read_statistics(spark, base), ["sst_hub1"])
    window = timewindow.time_window(None, latest=latest)
    return timewindow.within(store.read_table(spark, base, "sst_hub1", weeks=True), window).drop(*store.WEEK)


@query
def stored_fft_points(spark, sf_dir):
    base = scratch_path(spark, "weekly")
    standin.store(spark, sf_dir, base, FFT)
    spectra = spectrum.fft_union({key: store.read_table(spark, base, key, weeks=True) for key in FFT})
    bounds = statistics.latest_spectra(statistics.read_statistics(spark, base))
    return spectrum.fft_points(spectrum.fft_within(spectra, bounds=bounds))


@query
def stored_time_bounds(spark, sf_dir):
    base = scratch_path(spark, "weekly")
    standin.store(spark, sf_dir, base)
    return statistics.bounds_of(statistics.read_statistics(spark, base))


@query
def stored_coverage_missing(spark, sf_dir):
    base = scratch_path(spark, "weekly")
    standin.store(spark, sf_dir, base)
    return compare.coverage_of_statistics(registry.registry(spark), statistics.read_statistics(spark, base))


# Windows, weeks, bounds


@query
def range_filter(spark, sf_dir):
    rows = standin.sst(spark, sf_dir, "hub1")
    return timewindow.range_filter(rows, "2024-01-08 00:00:00", "2024-01-20 12:00:00")


@query
def last_7_days(spark, sf_dir):
    return timewindow.last_days(standin.sst(spark, sf_dir, "hub1"))


@query
def last_7_days_multi(spark, sf_dir):
    frames = standin.tables(spark, sf_dir, ARCH)
    window = timewindow.time_window(list(frames.values()))
    kept = [
        timewindow.within(f, window).select(F.lit(key[4:]).alias("hub"), "datetime")
        for key, f in frames.items()
    ]
    return store.union_by_name(*kept)


@query
def time_bounds(spark, sf_dir):
    return timewindow.time_bounds(standin.tables(spark, sf_dir))


@query
def time_bounds_multi(spark, sf_dir):
    return timewindow.time_bounds_multi(list(standin.tables(spark, sf_dir).values()))


def _order_weeks(spark, sf_dir):
    return standin.read(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("datetime"))


@query
def iso_week(spark, sf_dir):
    columns = timewindow.describe_week("datetime")
    return _order_weeks(spark, sf_dir).groupBy(*columns).agg(F.count("*").alias("n_orders"))


@query
def week_label(spark, sf_dir):
    rows = store.with_week(_order_weeks(spark, sf_dir))
    label = fn.week_label("iso_year", "iso_week").alias("week")
    return rows.groupBy(label).agg(F.count("*").alias("n_orders"))


@query
def week_spine(spark, sf_dir):
    orders = _order_weeks(spark, sf_dir)
    return timewindow.week_spine(orders.unionAll(standin.sst(spark, sf_dir, "hub1").select("datetime")))


# Report series


@query
def temps_col(spark, sf_dir):
    means = series.temps_col(standin.tables(spark, sf_dir, ["sst_hub1"]))
    return rounded(means, "T4", "T5", "T6").orderBy("bin_start")


@query
def temps_col_bins(spark, sf_dir):
    tables = standin.tables(spark, sf_dir, ["sst_hub1"])
    means = series.temps_col(tables, minutes=15, window=timewindow.FULL_WINDOW)
    return rounded(means, "T4", "T5", "T6").orderBy("bin_start")


@query
def temps_arch(spark, sf_dir):
    means = series.temps_arch(standin.tables(spark, sf_dir, ARCH))
    return rounded(means, "T1", "T2", "T3").orderBy("bin_start")


@query
def temps_arch_bins(spark, sf_dir):
    tables = standin.tables(spark, sf_dir, ARCH)
    means = series.temps_arch(tables, minutes=20, window=timewindow.FULL_WINDOW)
    return rounded(means, "T1", "T2", "T3").orderBy("bin_start")


@query
def strain_temp(spark, sf_dir):
    return series.strain_temp(standin.tables(spark, sf_dir, SST)).orderBy("sensor_id", "bin_start")


@query
def strain_temp_bins(spark, sf_dir):
    medians = series.strain_temp(standin.tables(spark, sf_dir, SST), minutes=20)
    return medians.orderBy("sensor_id", "bin_start")


@query
def registry_join(spark, sf_dir):
    readings = None
    for hub in HUBS:
        frame = standin.sst(spark, sf_dir, hub)
        part = frame.unpivot(["datetime"], frame.columns[1:], "sensor_id", "value")
        readings = part if readings is None else readings.unionByName(part)
    spectra = _fft(spark, sf_dir).select("datetime", "sensor_id", F.col("fft_main_a").alias("value"))
    # A sensor that no one has listed.
    unknown = standin.accel(spark, sf_dir).select("datetime", F.lit("X99").alias("sensor_id"), F.col("A30_t").alias("value"))
    readings = readings.unionByName(spectra).unionByName(unknown)
    columns = ["kind", "hub", "temp_sensor_id", "label"]
    known = registry.with_sensor(readings, registry.registry(spark), columns)
    return known.groupBy("sensor_id", *columns).agg(
        F.count("value").alias("n_values"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
    )


@query
def accel_minute(spark, sf_dir):
    minutes = series.accel_minute(standin.accel(spark, sf_dir))
    return rounded(minutes, "v_avg").orderBy("sensor_id", "minute")


@query
def accel_daily_grid(spark, sf_dir):
    grid = rounded(series.accel_daily_grid(standin.accel(spark, sf_dir)), "v_avg", "hour")
    return grid.orderBy("sensor_id", "day", "hour")


@query
def accel_day_range(spark, sf_dir):
    return series.accel_day_range(series.accel_daily_grid(standin.accel(spark, sf_dir)))


# Spectra


def _fft(spark, sf_dir):
    return spectrum.fft_union(standin.tables(spark, sf_dir, FFT))


@query
def fft_union(spark, sf_dir):
    return _fft(spark, sf_dir).select(
        "hub",
        "sensor_id",
        "datetime",
        "fft_main_f",
        "fft_main_a",
        F.size("fft_freqs").alias("n_freqs"),
        F.array_max("fft_amps").alias("amp_max"),
    )


@query
def fft_bounds(spark, sf_dir):
    return spectrum.fft_bounds(_fft(spark, sf_dir))


@query
def fft_points(spark, sf_dir):
    return spectrum.fft_points(spectrum.fft_within(_fft(spark, sf_dir)))


def _all_points(spark, sf_dir):
    return spectrum.fft_points(_fft(spark, sf_dir).where(F.col("sensor_id").isin(ACCELEROMETERS)))


@query
def fft_kde(spark, sf_dir):
    return rounded(spectrum.fft_kde(_all_points(spark, sf_dir)), "x", "density", digits=9)


@query
def fft_peak(spark, sf_dir):
    return rounded(spectrum.fft_peak(_all_points(spark, sf_dir)), "f_peak", "density", digits=9)


@query
def fft_kde_binned(spark, sf_dir):
    """Whether the approximate density lies within its bound of the exact one."""
    points = _all_points(spark, sf_dir)
    exact = spectrum.fft_kde(points).withColumnRenamed("density", "exact").drop("x")
    both = spectrum.fft_kde_binned(points).join(exact, ["sensor_id", "k"])
    # Sums in another order differ in their last digits.
    within = F.abs(F.col("density") - F.col("exact")) <= F.col("bound") + F.lit(1e-12)
    return rounded(both.select("sensor_id", "k", "x", within.alias("within_bound")), "x", digits=9)


@query
def fft_main_series(spark, sf_dir):
    return rounded(spectrum.fft_main_series(_fft(spark, sf_dir), 1440), "f_avg", "a_avg")


# Versions and coverage


@query
def diff_full_outer(spark, sf_dir):
    return compare.in_diff_order(compare.diff_full_outer(*standin.versions(spark, sf_dir)))


@query
def diff_except(spark, sf_dir):
    return compare.diff_except(*standin.versions(spark, sf_dir))


@query
def timestamp_presence(spark, sf_dir):
    old, new = standin.versions(spark, sf_dir)
    # Times of the old version, some microseconds off: the same milliseconds.
    micro = F.make_dt_interval(secs=(F.col("S7") * 0 + 0.000007).cast("decimal(18,6)"))
    moved = old.select((F.date_trunc("MILLISECOND", "datetime").cast("timestamp_ntz") + F.coalesce(micro, F.make_dt_interval())).alias("datetime"))
    diff = compare.diff_full_outer(old, new).select("datetime")
    return compare.timestamp_presence(diff.unionByName(moved), old, new)


@query
def compare_tables(spark, sf_dir):
    tables = standin.tables(spark, sf_dir)
    old, new = standin.versions(spark, sf_dir)
    before = {**tables, "sst_hub2": old}
    after = {**tables, "sst_hub2": new, "sst_hub1": tables["sst_hub1"].drop("T6")}
    del before["fft_hub4"], after["fft_hub1"]
    return compare.compare_tables(before, after)


@query
def compare_weeks(spark, sf_dir):
    old, new = standin.versions(spark, sf_dir)
    gauges = standin.sst(spark, sf_dir, "hub1")
    first = F.col("datetime") < F.lit("2024-01-08").cast("timestamp_ntz")
    last = F.col("datetime") >= F.lit("2024-01-22").cast("timestamp_ntz")
    before = {"sst_hub1": gauges.where(~last), "sst_hub2": old}
    after = {"sst_hub1": gauges.where(~first), "sst_hub2": new}
    return compare.compare_weeks(before, after)


@query
def compare_week_contents(spark, sf_dir):
    """As ``compare_weeks`` where weeks of equal counts may differ in a value."""
    old, new = standin.versions(spark, sf_dir)
    events = standin.events(spark, sf_dir)
    changed = events.withColumn("k", F.when(F.col("event_id") == 7, F.col("k") + 1).otherwise(F.col("k")))
    before = {"sst_hub1": standin.sst_of(events, "hub1"), "sst_hub2": old}
    after = {"sst_hub1": standin.sst_of(changed, "hub1"), "sst_hub2": new}
    return compare.compare_weeks(before, after, content=True)


@query
def differing_hours(spark, sf_dir):
    """Hours in which two stored versions differ, in the weeks whose statistics do."""
    known, stored = [], []
    for frame in standin.versions(spark, sf_dir):
        base = scratch_path(spark, "version")
        store.merge_weeks(store.with_week(frame), store.table_path(base, "sst_hub2"))
        statistics.update_statistics(spark, base, keys=["sst_hub2"])
        known.append(statistics.read_statistics(spark, base))
        stored.append(store.read_table(spark, base, "sst_hub2", weeks=True))
    weeks = [(r.iso_year, r.iso_week) for r in compare.differing_weeks(*known).collect()]
    return compare.differing_hours(*stored, weeks).select("hour", "rows_old", "rows_new")


@query
def lookup_times(spark, sf_dir):
    """Rows of a stored table at the times of some others."""
    base = scratch_path(spark, "weekly")
    standin.store(spark, sf_dir, base, ["sst_hub2"])
    events = standin.events(spark, sf_dir)
    wanted = events.where((F.col("event_type") == "error") & (F.col("k") % 2 == 0)).select("datetime")
    return compare.lookup_times(wanted, store.read_table(spark, base, "sst_hub2", weeks=True)).drop(*store.WEEK)


@query
def schema_diff(spark, sf_dir):
    old, new = standin.versions(spark, sf_dir)
    return compare.schema_diff(old, new.withColumn("S8", F.col("S8").cast("double")).drop("T1"))


@query
def coverage_missing(spark, sf_dir):
    return compare.coverage_missing(registry.registry(spark), standin.tables(spark, sf_dir))


@query
def weekly_backfill(spark, sf_dir):
    charts = weekly.weekly_backfill(standin.tables(spark, sf_dir))
    return rounded(charts, "value_min", "value_max", "f_peak")


@query
def coverage_gaps(spark, sf_dir):
    return gaps.coverage_gaps(registry.registry(spark), standin.tables(spark, sf_dir), 60)


@query
def backfill_changed_week(spark, sf_dir):
    """Reports of all weeks, stored before some rows of one week came and refreshed."""
    base = scratch_path(spark, "weekly")
    touched, path = [(2024, 2)], store.table_path(base, "sst_hub2")
    rows = store.with_week(standin.sst(spark, sf_dir, "hub2"))
    week = F.col("iso_year") * 100 + F.col("iso_week") == 202402
    store.merge_weeks(rows.where(~week | (F.hour("datetime") < 12)), path)
    standin.store(spark, sf_dir, base, [key for key in TABLE_KEYS if key != "sst_hub2"])
    statistics.update_statistics(spark, base, keys=["sst_hub2"])
    weekly.refresh_reports(spark, base)
    before = weekly.report_weeks(statistics.read_statistics(spark, base), touched)
    store.replace_weeks(rows.where(week), path, touched)
    statistics.update_statistics(spark, base, touched)
    weekly.refresh_reports(spark, base, before | weekly.report_weeks(statistics.read_statistics(spark, base), touched))
    return rounded(weekly.read_reports(spark, base), "value_min", "value_max", "f_peak")


# Results merged from parts


def _partials(spark, sf_dir, keys):
    base = scratch_path(spark, "weekly")
    standin.store(spark, sf_dir, base, keys)
    partials.update_partials(spark, base, keys=keys)
    return base, partials.read_partials(spark, base)


@query
def partial_temps_col(spark, sf_dir):
    base, parts = _partials(spark, sf_dir, ["sst_hub1"])
    latest = statistics.latest_time(statistics.read_statistics(spark, base), ["sst_hub1"])
    # The window of the rows begins within a minute, that of the minutes with one.
    low = F.date_trunc("MINUTE", latest).cast("timestamp_ntz") - timewindow.day_span(7)
    means = partials.means_of_partials(parts, series.COLUMN_THERMOMETERS, 60, (low, None))
    return rounded(means, "T4", "T5", "T6").orderBy("bin_start")


@query
def partial_day_range(spark, sf_dir):
    base, parts = _partials(spark, sf_dir, ["accel_all"])
    latest = statistics.latest_time(statistics.read_statistics(spark, base), ["accel_all"])
    return partials.day_range_of_partials(parts, latest)


@query
def partial_backfill(spark, sf_dir):
    base, parts = _partials(spark, sf_dir, partials.KEYS)
    tables = {**standin.tables(spark, sf_dir, FFT), **{key: store.read_table(spark, base, key) for key in partials.KEYS}}
    charts = weekly.weekly_backfill(tables, partials=parts, together=True)
    return rounded(charts, "value_min", "value_max", "f_peak")


@query
def sketch_medians(spark, sf_dir):
    """Daily medians merged from minute sketches, and whether their rank is near enough."""
    frame = standin.sst(spark, sf_dir, "hub1")
    names = sst_columns("hub1")
    merged = sketches.merged_medians(sketches.minute_sketches(frame, names), 1440)
    values = frame.select(fn.bin_start("datetime", 1440).alias("bin_start"), *names).unpivot(["bin_start"], names, "sensor_id", "v").where("v IS NOT NULL")
    ranks = values.join(merged, ["sensor_id", "bin_start"]).groupBy("sensor_id", "bin_start", "n").agg(
        F.avg((F.col("v") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("v") <= F.col("median")).cast("double")).alias("upto")
    )
    # Twice the error of 99 in a hundred, and one value for the way a middle is chosen.
    slack = F.lit(2 * sketches.rank_error()) + 1 / F.col("n")
    near = (F.col("below") <= 0.5 + slack) & (F.col("upto") >= 0.5 - slack)
    return ranks.select("sensor_id", "bin_start", "n", near.alias("within_error"))
