from helpers import at, rows, table, tables

from spanwatch.operators.compare import (
    compare_tables,
    coverage_missing,
    diff_except,
    diff_full_outer,
    differing,
    in_diff_order,
    matching,
    schema_diff,
    timestamp_presence,
)
from spanwatch.operators.registry import registry


def hub3(spark, *records):
    return table(spark, "sst_hub3", [{"datetime": r[0] and at(r[0]), "S15": r[1]} for r in records])


def test_rows_of_one_version_only(spark):
    old = hub3(spark, ("2025-12-01", 1.0), ("2025-12-02", 2.0), (None, 3.0))
    new = hub3(spark, ("2025-12-01", 9.0), ("2025-12-03", 4.0), ("2025-12-03", 5.0), (None, 6.0))
    diff = in_diff_order(diff_full_outer(old, new))
    got = [(r.new_dt, r.old_dt, r.new_S15, r.old_S15) for r in diff.collect()]
    assert got == [
        (at("2025-12-03"), None, 4.0, None),
        (at("2025-12-03"), None, 5.0, None),
        (None, at("2025-12-02"), None, 2.0),
        (None, None, 6.0, None),
        (None, None, None, 3.0),
    ]


def test_whole_rows_with_copies(spark):
    old = hub3(spark, ("2025-12-01", 1.0), ("2025-12-01", 1.0), ("2025-12-01", 1.0), ("2025-12-02", None))
    new = hub3(spark, ("2025-12-01", 1.0), ("2025-12-02", None), ("2025-12-02", 2.0))
    got = rows(diff_except(old, new).select("side", "datetime", "S15", "copies"), "side")
    assert got == [("new", at("2025-12-02"), 2.0, 1), ("old", at("2025-12-01"), 1.0, 2)]


def test_presence_looks_up_whole_milliseconds(spark):
    listed = hub3(spark, ("2025-12-01T00:00:00.250", 1.0), ("2025-12-01T00:00:01.000001", 1.0), ("2025-12-02", 1.0), (None, 1.0))
    old = hub3(spark, ("2025-12-01T00:00:00.250", 1.0), ("2025-12-01T00:00:00.250", 2.0))
    new = hub3(spark, ("2025-12-01T00:00:01.000001", 1.0), ("2025-12-01T00:00:01.000900", 1.0), ("2025-12-02", 1.0))
    assert rows(timestamp_presence(listed, old, new), "timestamp") == [
        ("2025-12-01 00:00:00.250", 2, 0),
        ("2025-12-01 00:00:01.000", 0, 2),
        ("2025-12-02 00:00:00.000", 0, 1),
    ]


def test_status_of_tables(spark):
    a, b = hub3(spark, ("2025-12-01", 1.0)), hub3(spark)
    old = {"same": a, "rows": a, "columns": a, "gone": a}
    new = {"same": a, "rows": b, "columns": a.drop("T2"), "added": b}
    got = compare_tables(old, new)
    assert rows(got, "file") == [
        ("added", "missing in OLD", None, 0, False),
        ("columns", "DIFF", 1, 1, False),
        ("gone", "missing in NEW", 1, None, False),
        ("rows", "DIFF", 1, 0, True),
        ("same", "OK", 1, 1, True),
    ]
    assert [r[0] for r in rows(matching(got))] == ["same"]
    assert differing(got).count() == 4


def test_schemas_side_by_side(spark):
    old = spark.sql("SELECT 1 AS a, 2.0D AS b, 'x' AS c")
    new = spark.sql("SELECT 1 AS a, cast(2 AS float) AS b")
    assert rows(schema_diff(old, new), "position") == [
        (1, "a", "int", "a", "int", True, 1, 1),
        (2, "b", "double", "b", "float", False, 1, 1),
        (3, "c", "string", None, None, False, 1, 1),
    ]


def test_missing_series(spark):
    frames = tables(
        spark,
        accel_all=[{"datetime": at("2025-12-01"), "A30_x": 1.0}, {"datetime": at("2025-12-15")}],
        sst_hub3=[{"datetime": at("2025-12-09"), "S15": 1.0, "T2": None}],
        fft_hub2=[{"datetime": at("2025-12-15"), "sensor_id": "A30"}],
    )
    missing = {(r.series, r.sensor_id, r.week) for r in coverage_missing(registry(spark), frames).collect()}
    assert len(missing) == 3 * (6 + 6 + 23 + 6) - 3
    for present in [("acceleration", "A30", "2025W49"), ("strain", "S15", "2025W50"), ("spectrum", "A30", "2025W51")]:
        assert present not in missing
    assert ("temperature", "T2", "2025W50") in missing
    assert ("acceleration", "A30", "2025W51") in missing
