import glob
import json
import time
from datetime import date

import pytest
from helpers import at, lines, rows

from spanwatch.model import TABLE_KEYS, table_schema
from spanwatch.operators.flatten import flatten
from spanwatch.operators.spectrum import fft_union
from spanwatch.plans.ingest import ingest, ingest_week
from spanwatch.plans.weekly import weekly_backfill, weekly_tables
from spanwatch.session import scratch_path, shared_folder
from spanwatch.sources.documents import export_day_slices, read_day_slices, read_week_slices
from spanwatch.sources.store import read_table, read_tables
from spanwatch.streaming.bins import LateRows, stream_accel_minute, stream_means
from spanwatch.streaming.ingest import merge_chunks, stream_ingest


def document(stamp, value):
    spectrum = [{"f": f, "a": 0.1 * f} for f in (1.0, 2.0, 2.0, 4.0)]
    return json.dumps(
        {
            "time": {"datetime": stamp},
            "A30": {"t": 1.0, "x": value, "y": 0.0, "z": 0.0, "fft": {"main": {"f": 2.0, "a": 0.2}, "spectrum": spectrum}},
            "S7": {"s": value},
            "T1": {"t": 4.0},
        }
    )


STAMPS = [
    "2025-12-01T00:00:01",
    "2025-12-01T00:00:31",
    "2025-12-01T01:00:00",
    "2025-12-07T23:59:59",
    "2025-12-08T00:00:00",
    "2025-12-08T00:30:00+02:00",
]


def documents(spark):
    texts = [document(s, float(i)) for i, s in enumerate(STAMPS)]
    return lines(spark, *texts, "{broken", '{"time": {"datetime": "soon"}}')


def values(frame):
    return [r[0] for r in rows(frame.select("S7"), "S7")]


def test_ingest_matches_flatten_and_can_be_repeated(spark, tmp_path):
    base = str(tmp_path / "weekly")
    for _ in range(2):
        ingest(spark, documents(spark), base)
    direct, stored = flatten(documents(spark)), read_tables(spark, base)
    for key in TABLE_KEYS:
        columns = direct[key].columns
        assert stored[key].select(columns).exceptAll(direct[key]).count() == 0, key
        assert direct[key].exceptAll(stored[key].select(columns)).count() == 0, key


def test_a_week_is_cut_by_the_text_of_its_documents(spark, tmp_path):
    base = str(tmp_path / "weekly")
    ingest_week(spark, documents(spark), base, 2025, 50)
    assert values(read_table(spark, base, "sst_hub2")) == [4.0, 5.0]
    ingest_week(spark, documents(spark), base, 2025, 49)
    kept = read_table(spark, base, "sst_hub2", weeks=True)
    assert rows(kept.groupBy("iso_week").count(), "iso_week") == [(49, 4), (50, 2)]
    assert read_table(spark, base, "sst_hub1").count() == 0


def test_quarantine_is_kept(spark, tmp_path):
    base = str(tmp_path / "weekly")
    for _ in range(2):
        ingest(spark, documents(spark), base)
    kept = spark.read.parquet(f"{base}/quarantine")
    assert rows(kept.select("reason", "stamp", "line"), "reason") == [
        ("not JSON", None, "{broken"),
        ("unreadable datetime", "soon", None),
    ]


def test_a_week_keeps_lines_that_are_not_json(spark, tmp_path):
    base = str(tmp_path / "weekly")
    faulty = documents(spark).union(lines(spark, '{"time": {"datetime": "2025-12-09Tsoon"}}'))
    for _ in range(2):
        ingest_week(spark, faulty, base, 2025, 50)
    kept = spark.read.parquet(f"{base}/quarantine").select("reason", "stamp", "line")
    assert rows(kept, "reason") == [("not JSON", None, "{broken"), ("unreadable datetime", "2025-12-09Tsoon", None)]


def test_a_family_without_rows_is_emptied_for_the_week(spark, tmp_path):
    base = str(tmp_path / "weekly")
    first = lines(spark, '{"time": {"datetime": "2025-12-02T00:00:00"}, "S15": {"s": 1}, "S7": {"s": 1}}', document("2025-11-25T00:00:00", 1.0))
    ingest(spark, first, base)
    corrected = lines(spark, '{"time": {"datetime": "2025-12-02T00:00:00"}, "S7": {"s": 2}}')
    ingest_week(spark, corrected, base, 2025, 49)
    assert read_table(spark, base, "sst_hub3").count() == 0
    assert values(read_table(spark, base, "sst_hub2")) == [1.0, 2.0]
    ingest(spark, lines(spark, '{"time": {"datetime": "2025-11-26T00:00:00"}, "S7": {"s": 5}}'), base)
    assert read_table(spark, base, "fft_hub2").count() == 0 and values(read_table(spark, base, "sst_hub2")) == [2.0, 5.0]


def test_stored_tables_have_exactly_their_schema(spark, tmp_path):
    base = str(tmp_path / "weekly")
    ingest(spark, documents(spark), base)
    for weeks in (False, True):
        for key, frame in read_tables(spark, base, weeks).items():
            assert frame.columns == table_schema(key).names + (["iso_year", "iso_week"] if weeks else []), key
    # Spectra of one hub only are on disk.
    assert fft_union(read_tables(spark, base)).count() == len(STAMPS)
    direct = weekly_backfill(flatten(documents(spark)))
    assert rows(weekly_backfill(read_tables(spark, base)), "chart", "sensor_id", "iso_week") == rows(direct, "chart", "sensor_id", "iso_week")


def test_nothing_is_left_in_scratch(spark, tmp_path):
    def parsed():
        return glob.glob(f"{shared_folder(spark).removeprefix('file:')}/spanwatch/parsed-*")

    before = parsed()
    ingest(spark, documents(spark), str(tmp_path / "weekly"))
    assert parsed() == before


def test_one_day_or_week_of_the_export(spark, tmp_path):
    path = str(tmp_path / "days")
    export_day_slices(documents(spark), path)
    assert read_day_slices(spark, path, date(2025, 12, 1)).count() == 3
    assert read_day_slices(spark, path, date(2025, 12, 2)).count() == 0
    week = read_week_slices(spark, path, 2025, 49)
    assert week.count() == 4
    assert "PartitionFilters: []" not in week._jdf.queryExecution().executedPlan().toString()


def test_weekly_report_of_all_weeks(spark):
    frames = flatten(documents(spark))
    charts = {tuple(r)[:4]: r for r in weekly_backfill(frames).collect()}
    # 2025-12-08T00:30+02:00 is 22:30 on the Sunday before.
    grid49 = charts[(2025, 49, "daily_v_grid", "A30")]
    assert (grid49.n_points, grid49.value_min, grid49.value_max) == (4, 0.0, 5.0)
    assert charts[(2025, 50, "daily_v_grid", "A30")].n_points == 1
    assert charts[(2025, 49, "strain_temp", "S7")].n_points == 4
    assert charts[(2025, 49, "temps_arch", "T1")].value_max == 4.0
    peak = charts[(2025, 49, "fft_kde", "A30")]
    assert peak.n_points == 5 * 4 and 1.5 < peak.f_peak < 2.5
    assert (2025, 49, "strain_temp", "S8") not in charts
    assert set(weekly_tables(frames)) == {"temps_col", "temps_arch", "strain_temp", "daily_v_grid", "fft_kde"}


def test_stream_equals_batch_and_continues(spark, tmp_path):
    source, chunks, checkpoint, base = (str(tmp_path / n) for n in ("in", "chunks", "check", "out"))
    texts = [r[0] for r in documents(spark).collect()]
    for part in (texts[:3], texts[3:]):
        lines(spark, *part).write.mode("append").text(source)
        query = stream_ingest(spark, source, chunks, checkpoint, max_files=1)
        assert query.awaitTermination(300) and query.exception() is None
        merge_chunks(spark, chunks, base)
    merge_chunks(spark, chunks, base)
    faults = spark.read.parquet(f"{chunks}/quarantine").select("reason")
    assert rows(faults, "reason") == [("not JSON",), ("unreadable datetime",)]
    batch = str(tmp_path / "batch")
    ingest(spark, documents(spark), batch)
    for key in TABLE_KEYS:
        streamed, expected = read_table(spark, base, key), read_table(spark, batch, key)
        assert streamed.exceptAll(expected).count() == 0, key
        assert expected.exceptAll(streamed).count() == 0, key


def test_a_batch_run_twice_writes_its_rows_once(spark, tmp_path):
    from spanwatch.streaming.ingest import _write_batch

    chunks, base = str(tmp_path / "chunks"), str(tmp_path / "out")
    for _ in range(2):
        _write_batch(documents(spark), 0, chunks)
    merge_chunks(spark, chunks, base)
    assert values(read_table(spark, base, "sst_hub2")) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def _run(query_frame, path, checkpoint):
    query = (
        query_frame.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(300) and query.exception() is None
    return query


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_streamed_bins_equal_batch_bins_once_closed(spark, tmp_path, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        _check_streamed_bins(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _check_streamed_bins(spark, tmp_path):
    from spanwatch.operators.series import accel_minute, mean_series

    frames = flatten(documents(spark))
    source = str(tmp_path / "accel")
    frames["accel_all"].coalesce(1).write.parquet(source)
    closing = frames["accel_all"].limit(1).selectExpr("timestamp_ntz'2025-12-20' AS datetime", *[c for c in frames["accel_all"].columns[1:]])
    late = closing.selectExpr("timestamp_ntz'2025-12-01 05:00:00' AS datetime", *closing.columns[1:])
    stream = spark.readStream.schema(frames["accel_all"].schema).option("maxFilesPerTrigger", 1)

    def means():
        return stream_means(stream.parquet(source), ["A30_x"], minutes=60)

    def minutes():
        return stream_accel_minute(stream.parquet(source), ["A30"])

    closing.coalesce(1).write.mode("append").parquet(source)
    paths = {n: str(tmp_path / n) for n in ("means", "minutes")}
    for name, frame in (("means", means()), ("minutes", minutes())):
        _run(frame, paths[name], str(tmp_path / f"check-{name}"))
    batch = mean_series(frames["accel_all"], ["A30_x"], 60)
    assert rows(spark.read.parquet(paths["means"]), "bin_start") == rows(batch, "bin_start")
    batch = accel_minute(frames["accel_all"], ["A30"])
    assert rows(spark.read.parquet(paths["minutes"]), "minute") == rows(batch, "minute")

    late.coalesce(1).write.mode("append").parquet(source)
    counter = LateRows()
    spark.streams.addListener(counter)
    try:
        query = _run(means(), paths["means"], str(tmp_path / "check-means"))
        for _ in range(100):
            if counter.dropped.get(str(query.id)):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counter)
    assert counter.dropped[str(query.id)] == 1


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark) + "/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("_", "."): v for k, v in conf.items()}

    here, far = "file:/home/spark-warehouse", "hdfs://store/warehouse/"
    assert shared_folder(Session(spark_master="local[8]", spark_sql_warehouse_dir=here)) == here
    assert shared_folder(Session(spark_master="yarn", spark_sql_warehouse_dir=far)) == far[:-1]
    assert shared_folder(Session(spark_master="yarn", spark_sql_warehouse_dir=here, spark_checkpoint_dir="hdfs://c/")) == "hdfs://c"
    with pytest.raises(ValueError):
        shared_folder(Session(spark_master="yarn", spark_sql_warehouse_dir=here))


@pytest.mark.parametrize("stamp, week", [("2024-12-30T00:00:00", (2025, 1)), ("2021-01-03T23:59:59", (2020, 53))])
def test_weeks_across_new_year_are_stored_by_iso_year(spark, tmp_path, stamp, week):
    base = str(tmp_path / "weekly")
    ingest(spark, lines(spark, document(stamp, 1.0)), base)
    row = read_table(spark, base, "accel_all", weeks=True).first()
    assert (row.iso_year, row.iso_week) == week and row.datetime == at(stamp)
