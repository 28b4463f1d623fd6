"""Runs of missing bins, across week borders, at the ends, and of sensors without values."""

from helpers import at, rows, tables

from spanwatch.operators.compare import coverage_missing, expected_series
from spanwatch.operators.gaps import coverage_gaps
from spanwatch.operators.registry import registry
from spanwatch.operators.timewindow import as_stamp


def sensor(spark, name):
    return registry(spark).where(f"sensor_id = '{name}'")


def hours(*stamps, **extra):
    return [{"datetime": at(s), "S15": 1.0, **extra} for s in stamps]


def gaps(frame):
    return [(r.gap_start, r.gap_end, r.n_bins) for r in frame.orderBy("gap_start").collect()]


def test_gap_over_a_week_border_is_one(spark):
    # 2025-12-07 is a Sunday.
    frames = tables(spark, sst_hub3=hours("2025-12-07T20:10:00", "2025-12-07T22:00:00", "2025-12-08T03:30:00", "2025-12-08T03:40:00"))
    found = coverage_gaps(sensor(spark, "S15"), frames, 60)
    assert gaps(found) == [(at("2025-12-07T21:00:00"), at("2025-12-07T22:00:00"), 1), (at("2025-12-07T23:00:00"), at("2025-12-08T03:00:00"), 4)]


def test_gap_over_whole_weeks(spark):
    frames = tables(spark, sst_hub3=hours("2025-11-04T00:00:00", "2025-11-27T00:00:00", "2025-11-27T01:00:00"))
    assert gaps(coverage_gaps(sensor(spark, "S15"), frames, 60)) == [(at("2025-11-04T01:00:00"), at("2025-11-27T00:00:00"), 23 * 24 - 1)]


def test_ends_and_silent_sensors(spark):
    frames = tables(
        spark,
        sst_hub3=hours("2025-12-01T05:00:00") + [{"datetime": at("2025-12-01T06:00:00")}, {"datetime": None, "S15": 1.0}],
        accel_all=[{"datetime": at("2025-12-01T02:00:00"), "A30_x": 1.0}, {"datetime": at("2025-12-01T08:00:00")}],
    )
    assert gaps(coverage_gaps(sensor(spark, "S15"), frames, 60)) == [
        (at("2025-12-01T02:00:00"), at("2025-12-01T05:00:00"), 3),
        (at("2025-12-01T06:00:00"), at("2025-12-01T09:00:00"), 3),
    ]
    silent = coverage_gaps(sensor(spark, "A31"), frames, 60)
    assert [(r.series, r.n_bins) for r in silent.orderBy("series").collect()] == [("acceleration", 7), ("spectrum", 7)]
    every = coverage_gaps(registry(spark), frames, 60).select("series", "sensor_id").distinct()
    assert every.count() == expected_series(registry(spark)).count()


def test_window_cuts_gaps(spark):
    frames = tables(spark, sst_hub3=hours("2025-12-01T00:00:00", "2025-12-01T04:00:00", "2025-12-01T09:00:00"))
    window = (as_stamp("2025-12-01 02:00:00"), as_stamp("2025-12-01 06:59:00"))
    assert gaps(coverage_gaps(sensor(spark, "S15"), frames, 60, window)) == [
        (at("2025-12-01T02:00:00"), at("2025-12-01T04:00:00"), 2),
        (at("2025-12-01T05:00:00"), at("2025-12-01T07:00:00"), 2),
    ]


def test_no_rows_no_gaps(spark):
    assert coverage_gaps(registry(spark), tables(spark), 60).count() == 0


def test_coverage_reads_each_table_once(spark, tmp_path):
    stored = {}
    for key, frame in tables(spark, sst_hub3=hours("2025-12-01T00:00:00")).items():
        frame.write.parquet(str(tmp_path / key))
        stored[key] = spark.read.parquet(str(tmp_path / key))
    missing = coverage_missing(registry(spark), stored)
    assert rows(missing.where("sensor_id = 'S15'")) == [] and missing.where("sensor_id = 'S16'").count() == 1
    assert missing._jdf.queryExecution().explainString(missing.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).count("FileScan") <= 9
