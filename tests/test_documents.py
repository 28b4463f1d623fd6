import json
from datetime import date

import pytest
from helpers import lines, rows

from spanwatch.sources.documents import (
    as_json_lines,
    count_day_slices,
    day_slices,
    export_day_slices,
    previous_week,
    read_documents,
    sample_documents,
    scan_range,
    scan_week,
    week_range,
)


def doc(stamp):
    return json.dumps({"time": {"datetime": stamp}})


def test_week_range():
    assert week_range(2025, 1) == ("2024-12-30T00:00:00", "2025-01-06T00:00:00")


@pytest.mark.parametrize(
    "today, expected",
    [
        (date(2025, 12, 10), (2025, 49)),
        (date(2025, 1, 3), (2024, 52)),
        (date(2021, 1, 5), (2020, 53)),
        (date(2024, 12, 30), (2024, 52)),
    ],
)
def test_previous_week(today, expected):
    assert previous_week(today) == expected


def test_scan_compares_text_half_open(spark):
    stamps = [
        "2025-11-30T23:59:59.9",
        "2025-12-01T00:00:00",
        "2025-12-01T00:30:00+02:00",
        "2025-12-07T23:59:59",
        "2025-12-08T00:00:00",
    ]
    kept = scan_week(lines(spark, *[doc(s) for s in stamps], "{broken"), 2025, 49)
    assert [r[0] for r in rows(kept.select("stamp"), "stamp")] == stamps[1:4]
    assert scan_range(lines(spark, doc(stamps[1])), "2025-12-02", "2025-12-03").count() == 0


def test_day_slices_are_named_by_week_and_day(spark):
    docs = lines(spark, doc("2024-12-30T05:00:00"), doc("2025-03-09T00:00:00"), doc("soon"), "{}")
    assert [r[0] for r in rows(day_slices(docs).select("slice"), "slice")] == ["2025W01_1", "2025W10_7"]
    assert [tuple(r)[::2] for r in rows(count_day_slices(docs), "slice")] == [("2025W01_1", 1), ("2025W10_7", 1)]


def test_export_replaces_only_the_days_it_writes(spark, tmp_path):
    path = str(tmp_path / "days")
    first = lines(spark, doc("2025-12-01T01:00:00"), doc("2025-12-02T01:00:00"))
    export_day_slices(first, path)
    export_day_slices(first, path)
    export_day_slices(lines(spark, doc("2025-12-02T02:00:00")), path)
    written = spark.read.text(path).select("slice", "value")
    assert rows(written, "slice") == [
        ("2025W49_1", doc("2025-12-01T01:00:00")),
        ("2025W49_2", doc("2025-12-02T02:00:00")),
    ]
    assert read_documents(spark, path).count() == 2


def test_typed_rows_become_lines(spark, tmp_path):
    frame = spark.sql("SELECT named_struct('datetime', '2025-12-01T00:00:00') AS time, date'2025-12-01' AS d")
    (line,) = rows(as_json_lines(frame))[0]
    assert json.loads(line) == {"time": {"datetime": "2025-12-01T00:00:00"}, "d": "2025-12-01"}
    path = str(tmp_path / "typed")
    frame.write.parquet(path)
    assert rows(read_documents(spark, path, format="parquet")) == [(line,)]


def test_sample(spark):
    docs = lines(spark, doc("2025-12-02"), doc("2025-12-01"))
    assert sample_documents(docs).count() == 1
    assert rows(sample_documents(docs, 1, order="value")) == [(doc("2025-12-01"),)]
