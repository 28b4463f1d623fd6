"""Week statistics: right after every kind of write, and read instead of the tables."""

import pytest
from helpers import at, lines, rows, table

from spanwatch.operators import compare, registry
from spanwatch.operators.spectrum import fft_points, fft_union, fft_within
from spanwatch.operators.timewindow import time_window, within
from spanwatch.plans.ingest import ingest, ingest_week
from spanwatch.sources.statistics import bounds_of, latest_spectra, latest_time, read_statistics, rows_digest, update_statistics, week_statistics
from spanwatch.sources.store import merge_weeks, read_table, read_tables, table_path, with_week


def hub3(spark, *days, value=1.0):
    return with_week(table(spark, "sst_hub3", [{"datetime": at(f"{d}T12:00:00"), "S15": value + i} for i, d in enumerate(days)]))


def of(spark, base, key="sst_hub3"):
    found = read_statistics(spark, base).where(f"table_key = '{key}'").select("iso_week", "sensor_id", "n_rows", "first_dt", "last_dt")
    return rows(found, "iso_week", "sensor_id")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_of_one_table(spark):
    frame = with_week(
        table(spark, "sst_hub3", [{"datetime": at("2025-12-01T00:00:00"), "S15": 1.0}, {"datetime": at("2025-12-02T00:00:00")}, {"datetime": at("2025-12-09T00:00:00"), "T2": 0.0}])
    )
    got = rows(week_statistics(frame, "sst_hub3").drop("digest"), "iso_week", "sensor_id")
    assert got == [
        ("sst_hub3", 2025, 49, None, 2, at("2025-12-01"), at("2025-12-02")),
        ("sst_hub3", 2025, 49, "S15", 1, at("2025-12-01"), at("2025-12-01")),
        ("sst_hub3", 2025, 50, None, 1, at("2025-12-09"), at("2025-12-09")),
        ("sst_hub3", 2025, 50, "T2", 1, at("2025-12-09"), at("2025-12-09")),
    ]


def test_of_spectra_and_of_nothing(spark):
    frame = with_week(table(spark, "fft_hub1", [{"datetime": at(f"2025-12-0{d}"), "sensor_id": s} for d, s in ((1, "A33"), (2, "A33"), (3, "A34"))]))
    got = rows(week_statistics(frame, "fft_hub1").select("sensor_id", "n_rows", "last_dt"), "sensor_id")
    assert got == [(None, 3, at("2025-12-03")), ("A33", 2, at("2025-12-02")), ("A34", 1, at("2025-12-03"))]
    assert week_statistics(frame.limit(0), "fft_hub1").count() == 0 and week_statistics(hub3(spark, "2025-12-01").limit(0), "sst_hub3").count() == 0


def test_touched_weeks_are_replaced_and_emptied_ones_go(spark, tmp_path):
    base, path = str(tmp_path), table_path(str(tmp_path), "sst_hub3")
    assert of(spark, base) == []
    merge_weeks(hub3(spark, "2025-11-25", "2025-12-02"), path)
    update_statistics(spark, base)
    merge_weeks(hub3(spark, "2025-12-02", "2025-12-03"), path)
    update_statistics(spark, base, [(2025, 49)])
    assert [r[:3] for r in of(spark, base)] == [(48, None, 1), (48, "S15", 1), (49, None, 2), (49, "S15", 2)]
    ingest(spark, lines(spark, '{"time": {"datetime": "2025-12-02T00:00:00"}, "S7": {"s": 1}}'), base)
    assert [r[:3] for r in of(spark, base)] == [(48, None, 1), (48, "S15", 1)]
    ingest_week(spark, lines(spark), base, 2025, 48)
    assert of(spark, base) == [] and [r[:3] for r in of(spark, base, "sst_hub2")] == [(49, None, 1), (49, "S7", 1)]


def test_digest_needs_no_order_and_sees_every_value(spark):
    def digest(records):
        frame = table(spark, "sst_hub3", records)
        return frame.agg(rows_digest(frame.columns)).first()[0]

    a, b = {"datetime": at("2025-12-01"), "S15": 1.0}, {"datetime": at("2025-12-02"), "S16": 2.0}
    whole = digest([a, b, b])
    assert whole == digest([b, a, b])
    assert whole != digest([a, a, b]) and whole != digest([a, b])
    # The same value in another column.
    assert digest([a]) != digest([{"datetime": at("2025-12-01"), "S16": 1.0}])


@pytest.fixture
def stored(spark, tmp_path):
    base = str(tmp_path / "weekly")
    days = ["2025-11-04", "2025-11-12", "2025-11-28", "2025-12-01", "2025-12-03"]
    merge_weeks(hub3(spark, *days), table_path(base, "sst_hub3"))
    spectra = [{"datetime": at(d), "sensor_id": s, "fft_freqs": [1.0], "fft_amps": [0.5]} for d in days for s in ("A33", "A34") if (d, s) != ("2025-12-03", "A34")]
    merge_weeks(with_week(table(spark, "fft_hub1", spectra)), table_path(base, "fft_hub1"))
    update_statistics(spark, base)
    return base


def test_windows_open_the_newest_weeks_only(spark, stored):
    statistics = read_statistics(spark, stored)
    frame = read_table(spark, stored, "sst_hub3", weeks=True)
    kept = within(frame, time_window(None, latest=latest_time(statistics, ["sst_hub3"])))
    assert [r[0].day for r in rows(kept.select("datetime"), "datetime")] == [28, 1, 3]
    plan = plan_of(kept)
    # One scan of the table, the bound from the statistics, and weeks chosen before any is opened.
    assert plan.count("sst_hub3") and "week_statistics" in plan
    assert "PartitionFilters: [isnotnull" in plan or "dynamicpruning" in plan or "iso_year" in plan.split("PartitionFilters:")[1][:300]
    opened = kept.selectExpr("_metadata.file_path").distinct().collect() if "_metadata" in kept.columns else kept.select("iso_week").distinct().collect()
    assert {r[0] for r in opened} == {48, 49}


def test_spectra_by_the_statistics_equal_those_by_the_table(spark, stored):
    tables = read_tables(spark, stored, weeks=True)
    direct = fft_points(fft_within(fft_union(read_tables(spark, stored))))
    by_statistics = fft_points(fft_within(fft_union(tables), bounds=latest_spectra(read_statistics(spark, stored))))
    assert rows(by_statistics, "sensor_id") == rows(direct, "sensor_id") and direct.count() == 5


def test_bounds_and_coverage_without_the_tables(spark, stored):
    statistics = read_statistics(spark, stored)
    bounds = {r.table_key: (r.start_dt, r.end_dt) for r in bounds_of(statistics).collect()}
    assert bounds["sst_hub3"] == (at("2025-11-04T12:00:00"), at("2025-12-03T12:00:00")) and bounds["accel_all"] == (None, None)
    sensors = registry.registry(spark)
    direct = compare.coverage_missing(sensors, read_tables(spark, stored))
    known = compare.coverage_of_statistics(sensors, statistics)
    assert rows(known, "series", "sensor_id", "monday") == rows(direct, "series", "sensor_id", "monday")
    # S15 has no value in the week of 2025-11-17 only.
    assert [r.week for r in direct.where("sensor_id = 'S15'").collect()] == ["2025W47"]


def test_versions_differ_in_one_value(spark, tmp_path):
    bases = [str(tmp_path / n) for n in ("old", "new")]
    for base, value in zip(bases, (1.0, 5.0), strict=True):
        both = hub3(spark, "2025-11-25", "2025-11-26").unionByName(hub3(spark, "2025-12-02", "2025-12-03", value=value))
        merge_weeks(both, table_path(base, "sst_hub3"))
        update_statistics(spark, base)
    known = [read_statistics(spark, base) for base in bases]
    differ = rows(compare.differing_weeks(*known))
    assert differ == [("sst_hub3", 2025, 49, 2, 2)]
    old, new = ({"sst_hub3": read_table(spark, base, "sst_hub3")} for base in bases)
    assert rows(compare.compare_weeks(old, new).select("iso_week", "status"), "iso_week") == [(48, "OK"), (49, "OK")]
    assert rows(compare.compare_weeks(old, new, content=True).select("iso_week", "status"), "iso_week") == [(48, "OK"), (49, "DIFF")]
    stored = [read_table(spark, base, "sst_hub3", weeks=True) for base in bases]
    for weeks in (None, [(2025, 49)]):
        hours = compare.differing_hours(*stored, weeks)
        assert rows(hours, "hour") == [(2025, 49, at("2025-12-02T12:00:00"), 1, 1), (2025, 49, at("2025-12-03T12:00:00"), 1, 1)]
    assert "PartitionFilters: []" not in plan_of(hours) and "202549" in plan_of(hours)
    assert compare.differing_hours(*stored, []).count() == 0


def test_times_are_looked_up_in_their_weeks(spark, stored):
    frame = read_table(spark, stored, "sst_hub3", weeks=True)
    wanted = spark.sql("SELECT timestamp_ntz'2025-12-01 12:00:00.0004' AS datetime UNION ALL SELECT timestamp_ntz'2025-12-01 13:00:00' UNION ALL SELECT NULL")
    found = compare.lookup_times(wanted, frame)
    assert rows(found.select("datetime", "S15")) == [(at("2025-12-01T12:00:00"), 4.0)] and found.columns == frame.columns
    plan = plan_of(found)
    assert "dynamicpruning" in plan.lower() or "PartitionFilters: [isnotnull" in plan
    assert compare.lookup_times(wanted.limit(0), frame).count() == 0
