import math

import numpy as np
import pytest
from helpers import at, rows, table, tables
from pyspark.sql import functions as F

from spanwatch.operators.spectrum import (
    fft_bounds,
    fft_kde,
    fft_main_series,
    fft_peak,
    fft_points,
    fft_union,
    fft_within,
)


def spectrum(spark, *records):
    names = ("datetime", "sensor_id", "fft_freqs", "fft_amps", "fft_main_f", "fft_main_a")
    return table(spark, "fft_hub2", [dict(zip(names, (at(r[0]), *r[1:]))) for r in records])


def test_points_reach_the_threshold_in_single_precision(spark):
    frame = spectrum(spark, ("2025-12-01", "A30", [1.0, 2.0, 3.0, 4.0], [0.08, 0.0799, None, 0.5]))
    assert [r[:2] for r in rows(fft_points(frame), "freq")] == [("A30", 1.0), ("A30", 4.0)]
    nan = spectrum(spark, ("2025-12-01", "A30", [1.0], [math.nan]))
    assert fft_points(nan).count() == 1


def test_lists_of_different_length(spark):
    frame = spectrum(
        spark,
        ("2025-12-01", "A30", [1.0, 2.0], [0.5, 0.5, 0.75]),
        ("2025-12-01", "A31", [1.0, 2.0, 3.0], [0.5]),
        ("2025-12-01", "A32", [], []),
    )
    got = rows(fft_points(frame), "sensor_id", F.col("freq").asc_nulls_last())
    assert got == [("A30", 1.0, 0.5), ("A30", 2.0, 0.5), ("A30", None, 0.75), ("A31", 1.0, 0.5)]


def test_each_sensor_has_its_own_last_days(spark):
    frame = spectrum(
        spark,
        ("2025-12-01", "A30", [1.0], [1.0]),
        ("2025-12-09", "A30", [1.0], [1.0]),
        ("2025-11-01", "A31", [1.0], [1.0]),
        ("2025-10-25", "A31", [1.0], [1.0]),
        ("2025-12-09", "A77", [1.0], [1.0]),
    )

    def kept(**window):
        got = fft_within(frame, **window).select("sensor_id", "datetime")
        return [(s, d.day) for s, d in rows(got, "sensor_id", "datetime")]

    assert kept() == [("A30", 9), ("A31", 25), ("A31", 1)]
    assert kept(sensors=["A30"]) == [("A30", 9)]
    assert kept(start="2025-10-30") == [("A30", 1), ("A30", 9), ("A31", 1)]
    assert kept(end="2025-12-02") == [("A30", 1)]
    assert rows(fft_bounds(frame, ["A31"])) == [("A31", at("2025-10-25"), at("2025-11-01"))]
    assert fft_within(frame, sensors=["A32"]).count() == 0


def density(freqs, points=500):
    """Plain kernel density: one Gaussian per point, Scott's width."""
    freqs = np.asarray(freqs, dtype=np.float32).astype(float)
    n = len(freqs)
    h = math.sqrt(np.var(freqs, ddof=1)) * n ** (-1 / 5)
    xs = np.linspace(freqs.min(), freqs.max(), points)
    ys = [sum(math.exp(-(((x - f) / h) ** 2) / 2) for f in freqs) / (n * h * math.sqrt(2 * math.pi)) for x in xs]
    return xs, np.array(ys)


FREQS = {
    "two": [1.0, 4.0],
    "bins": [2.0] * 30 + [2.5] * 50 + [7.0] * 20 + [7.5],
    "near": [12.5, 12.500001, 12.500002, 12.500001],
    "spread": [0.1 * i**1.5 for i in range(60)],
}


def points(spark, groups=FREQS):
    data = [(g, f, 0.1 + i / 100) for g, fs in groups.items() for i, f in enumerate(fs)]
    return spark.createDataFrame(data, "sensor_id string, freq float, amp float")


@pytest.mark.parametrize("slices", [1, 32])
def test_density_against_the_plain_form(spark, slices):
    got = {}
    for g, k, x, d in rows(fft_kde(points(spark), slices=slices), "sensor_id", "k"):
        got.setdefault(g, []).append((x, d))
    assert got.keys() == FREQS.keys()
    for g, freqs in FREQS.items():
        xs, ys = density(freqs)
        assert np.allclose([p[0] for p in got[g]], xs, rtol=1e-12)
        assert np.allclose([p[1] for p in got[g]], ys, rtol=1e-9)


def test_peaks(spark):
    got = {r.sensor_id: r for r in fft_peak(points(spark)).collect()}
    for g, freqs in FREQS.items():
        xs, ys = density(freqs)
        assert got[g].density == pytest.approx(ys.max(), rel=1e-9)
        assert got[g].n_points == len(freqs)
        assert got[g].amp_min == pytest.approx(0.1)
        assert got[g].amp_max == pytest.approx(0.1 + (len(freqs) - 1) / 100)
    xs, ys = density(FREQS["bins"])
    assert got["bins"].f_peak == pytest.approx(xs[ys.argmax()])


def test_of_equal_densities_the_lowest_frequency_wins(spark):
    flat = spark.createDataFrame([("a", 1, 5.0, 1.0), ("a", 0, 4.0, 1.0)], "g string, k int, x double, density double")
    top = flat.groupBy("g").agg(F.max_by("x", F.struct("density", (-F.col("k")).alias("first"))))
    assert rows(top) == [("a", 4.0)]


def test_groups_without_a_density_are_left_out(spark):
    groups = {"one": [1.0], "same": [2.0, 2.0, 2.0], "fine": [1.0, 2.0]}
    assert {r[0] for r in rows(fft_kde(points(spark, groups)).select("sensor_id"))} == {"fine"}
    unread = spark.createDataFrame([("a", None, 1.0), ("a", 1.0, 1.0)], "sensor_id string, freq float, amp float")
    assert fft_kde(unread).count() == 0 and fft_peak(unread).count() == 0


def test_density_integrates_to_just_under_one(spark):
    bell = [5.0] * 40 + [4.5, 5.5] * 20 + [4.0, 6.0] * 8 + [2.0, 8.0]
    got = rows(fft_kde(points(spark, {"bell": bell})).select("x", "density"), "x")
    area = np.trapezoid([r[1] for r in got], [r[0] for r in got])
    assert 0.98 < area < 1.0


def test_union_and_main_series(spark):
    record = {"datetime": at("2025-12-01T00:10"), "sensor_id": "A30", "fft_main_f": 2.0, "fft_main_a": 0.5}
    later = {**record, "datetime": at("2025-12-01T00:50"), "fft_main_f": 4.0, "fft_main_a": None}
    union = fft_union(tables(spark, fft_hub2=[record, later], fft_hub1=[{**record, "sensor_id": "A33"}]))
    assert rows(union.select("hub", "sensor_id"), "sensor_id") == [("hub2", "A30"), ("hub2", "A30"), ("hub1", "A33")]
    got = rows(fft_main_series(union), "sensor_id")[0]
    assert got == ("A30", at("2025-12-01T00:00"), 60, 2, 3.0, 2.0, 4.0, 0.5, 0.5, 0.5)
