"""Results merged from minutes equal those from rows; sketches stay within their error."""

import math
import random
import threading
from datetime import timedelta

import pytest
from helpers import at, rows, table, tables
from pyspark.sql import functions as F

from spanwatch.operators.medians import exact_median, median_of_counts, value_counts
from spanwatch.operators.partials import (
    KEYS,
    accel_minute_of_partials,
    day_range_of_partials,
    means_of_partials,
    merged_bins,
    minute_partials,
    read_partials,
    update_partials,
)
from spanwatch.operators.series import accel_daily_grid, accel_day_range, accel_minute, mean_series
from spanwatch.operators.sketches import merged_medians, minute_sketches, rank_error
from spanwatch.operators.timewindow import FULL_WINDOW
from spanwatch.plans import standin, weekly
from spanwatch.plans.weekly import weekly_backfill
from spanwatch.sources.store import merge_weeks, read_table, replace_weeks, table_path, with_week


def records(n=400, seed=3):
    rng = random.Random(seed)
    start = at("2025-11-28T22:00:00")
    found = []
    for _ in range(n):
        row = {"datetime": start + timedelta(seconds=rng.randrange(4 * 86400))}
        row |= {c: None if rng.random() < 0.3 else float(rng.randrange(1000)) / 8 for c in ("S27", "T4", "T5")}
        found.append(row)
    return [*found, {"datetime": None, "T4": 9.0}, {"datetime": at("2025-12-05T00:00:30")}]


def near(a, b):
    return len(a) == len(b) and all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9)) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True)
    )


@pytest.mark.parametrize("minutes", [1, 20, 60, 1440])
def test_means_of_any_bin(spark, minutes):
    frame = table(spark, "sst_hub1", records())
    direct = mean_series(frame.where("datetime IS NOT NULL"), ["T4", "T5", "T6"], minutes)
    merged = means_of_partials(minute_partials(frame, "sst_hub1"), ["T4", "T5", "T6"], minutes)
    assert near(rows(merged, "bin_start"), rows(direct, "bin_start"))
    with pytest.raises(ValueError):
        merged_bins(minute_partials(frame, "sst_hub1"), 0)


def test_resultants(spark):
    data = [{"datetime": at(f"2025-12-0{d}T00:00:{s:02d}"), "A30_x": float(d * s), "A30_y": 1.0, "A30_z": None if s == 7 else 2.0} for d in (1, 3, 9) for s in range(9)]
    frame = table(spark, "accel_all", data)
    parts = minute_partials(frame, "accel_all")
    assert near(rows(accel_minute_of_partials(parts, ["A30", "A31"]), "sensor_id", "minute"), rows(accel_minute(frame, ["A30", "A31"]), "sensor_id", "minute"))
    direct = accel_day_range(accel_daily_grid(frame, ["A30"]))
    assert rows(day_range_of_partials(parts, F.lit(at("2025-12-09T00:00:08")), ["A30"]), "day") == rows(direct, "day")


def test_kept_by_week(spark, tmp_path):
    base, path = str(tmp_path), table_path(str(tmp_path), "sst_hub1")
    assert read_partials(spark, base).count() == 0
    frame = with_week(table(spark, "sst_hub1", records()).where("datetime IS NOT NULL"))
    merge_weeks(frame, path)
    update_partials(spark, base, keys=["sst_hub1"])
    whole = means_of_partials(read_partials(spark, base), ["T4"], 60)
    assert near(rows(whole, "bin_start"), rows(mean_series(frame, ["T4"], 60), "bin_start"))
    later = frame.where("iso_week = 49 AND T4 > 50")
    replace_weeks(later, path, [(2025, 49)])
    update_partials(spark, base, [(2025, 49)], ["sst_hub1"])
    now = read_table(spark, base, "sst_hub1")
    assert near(rows(means_of_partials(read_partials(spark, base), ["T4"], 60), "bin_start"), rows(mean_series(now, ["T4"], 60), "bin_start"))
    replace_weeks(frame.limit(0), path, [(2025, 49)])
    update_partials(spark, base, [(2025, 49)], ["sst_hub1"])
    assert rows(read_partials(spark, base).select("iso_week").distinct()) == [(48,)]


def test_backfill_from_partials(spark):
    frames = tables(spark, sst_hub1=records(), accel_all=[{"datetime": at("2025-12-01"), "A30_x": 3.0, "A30_y": 4.0, "A30_z": 0.0}])
    parts = None
    for key in KEYS:
        part = minute_partials(frames[key], key)
        parts = part if parts is None else parts.unionByName(part)
    order = ["iso_year", "iso_week", "chart", "sensor_id"]
    assert near(rows(weekly_backfill(frames, partials=parts), *order), rows(weekly_backfill(frames), *order))


def test_backfill_reads_each_table_once(spark, tmp_path):
    stored = {}
    for key, frame in tables(spark, sst_hub1=records(20)).items():
        frame.write.parquet(str(tmp_path / key))
        stored[key] = spark.read.parquet(str(tmp_path / key))
    charts = weekly_backfill(stored)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = charts._jdf.queryExecution().explainString(mode)
    # The nine tables were read to count; what is left reads the counts and accelerations.
    assert plan.count("FileScan") + 8 <= 14 and charts.count() > 0


def test_mean_beside_the_median(spark):
    data = spark.createDataFrame([(k % 5, None if k % 7 == 0 else float(k * k % 101)) for k in range(300)] + [(9, None), (9, None)], "g int, v float")
    both = median_of_counts(value_counts(data, ["g"], "v"), ["g"], "median", mean="mean")
    means = {r.g: r.m for r in data.groupBy("g").agg(F.avg("v").alias("m")).collect()}
    for r in both.join(exact_median(data, ["g"], "v", "other"), "g").collect():
        assert r.median == r.other and (r.mean == means[r.g] or math.isclose(r.mean, means[r.g], rel_tol=1e-12))


def test_sketches_merge_within_their_error(spark):
    rng = random.Random(1)
    values = [rng.gauss(20, 5) for _ in range(20000)]
    frame = spark.createDataFrame([(at("2025-11-03T00:00:00") + timedelta(minutes=i % 700), v, None) for i, v in enumerate(values)], "datetime timestamp_ntz, T4 float, T5 float")
    frame = frame.unionByName(spark.createDataFrame([(None, 1.0, 1.0), (at("2025-11-03"), float("nan"), 7.0)], frame.schema))
    sketches = minute_sketches(frame, ["T4", "T5"])
    month = {r.sensor_id: r for r in merged_medians(sketches, 44640).collect()}
    assert month["T4"].n == 20000 and (month["T5"].n, month["T5"].median) == (1, 7.0)
    rank = sum(v <= month["T4"].median for v in values) / len(values)
    assert abs(rank - 0.5) <= 2 * rank_error() + 1e-4 and 0.013 < rank_error() < 0.0135
    assert minute_sketches(frame.limit(0), ["T4"]).count() == 0 and FULL_WINDOW == (None, None)


def test_backfill_of_stored_tables_writes_no_rows_of_hubs(spark, tmp_path, monkeypatch):
    base, stored = str(tmp_path), {}
    for key, frame in tables(spark, sst_hub1=records()).items():
        merge_weeks(with_week(frame), table_path(base, key))
        stored[key] = read_table(spark, base, key)
    order = ["iso_year", "iso_week", "chart", "sensor_id"]
    want = rows(weekly_backfill(stored), *order)
    staged, stage = [], weekly._stage
    monkeypatch.setattr(weekly, "_stage", lambda frame, name: staged.append(name) or stage(frame, name))
    assert near(rows(weekly_backfill(stored, together=True), *order), want)
    assert staged and not [name for name in staged if name.startswith("binned")]


def test_replacing_weeks_computes_the_rows_once(spark, tmp_path):
    path, seen = str(tmp_path / "sst_hub1"), spark.sparkContext.accumulator(0)
    stored = lambda: rows(spark.read.parquet(path).select("T4"), "T4")
    frame = with_week(table(spark, "sst_hub1", [{"datetime": at(s), "T4": v} for s, v in (("2025-12-01", 1.0), ("2025-12-08", 2.0))]))
    replace_weeks(frame, path, [(2025, 49), (2025, 50)])
    assert stored() == [(1.0,), (2.0,)]

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    replace_weeks(frame.where("T4 > 1").mapInArrow(counted, frame.schema), path, [(2025, 49), (2025, 50)])
    assert seen.value == 1 and stored() == [(2.0,)]
    replace_weeks(frame.where("T4 > 1"), path, [(2025, 50)])
    assert stored() == [(2.0,)]


def test_tables_are_stored_side_by_side(spark, tmp_path, monkeypatch):
    meet = threading.Barrier(2, timeout=60)
    merge = standin.merge_weeks
    monkeypatch.setattr(standin, "merge_weeks", lambda frame, path: meet.wait() + 1 and merge(frame, path))
    frames = tables(spark, sst_hub1=records(), sst_hub2=[{"datetime": at("2025-12-01"), "T1": 1.0}])
    monkeypatch.setattr(standin, "table", lambda spark, sf_dir, key: frames[key])
    standin.store(spark, "", str(tmp_path), ["sst_hub1", "sst_hub2"])
    for key in ("sst_hub1", "sst_hub2"):
        assert read_table(spark, str(tmp_path), key).count() == frames[key].count()
