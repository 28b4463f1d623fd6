import math

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from spanwatch.functions import (
    at_or_above,
    bin_number,
    bin_start,
    day_index,
    day_label,
    document_float,
    has_quoted_reading,
    hours_since_midnight,
    iso_week,
    iso_year,
    numbered_bin_start,
    parse_iso,
    week_label,
    week_start,
)

ISO_TEXTS = [
    ("2025-12-01T00:00:01.250", at("2025-12-01T00:00:01.250")),
    ("2025-12-01", at("2025-12-01")),
    ("2025-12-01T10", at("2025-12-01T10:00")),
    ("2025-12-01 10:15", at("2025-12-01T10:15")),
    ("2025-12-01T10:00:00Z", at("2025-12-01T10:00")),
    ("2025-12-01T10:00:00+02:00", at("2025-12-01T08:00")),
    ("2025-12-01T00:30:00+0100", at("2025-11-30T23:30")),
    ("2025-12-01T10:00:00,5-03:30", at("2025-12-01T13:30:00.5")),
    ("2025-12-01T10:00:00+02:00:30", at("2025-12-01T07:59:30")),
    ("2025-12-01T10:00:00.123456789", at("2025-12-01T10:00:00.123456")),
    ("2025-03-09T02:30:00", at("2025-03-09T02:30")),
    ("2025-13-01", None),
    ("2025-12-01T25:00", None),
    ("2025", None),
    ("T10:00", None),
    ("10:00", None),
    ("yesterday", None),
    ("", None),
    (None, None),
]


def test_parse_iso(spark):
    frame = spark.createDataFrame([(t,) for t, _ in ISO_TEXTS], "t string")
    assert [r[0] for r in frame.select(parse_iso("t")).collect()] == [v for _, v in ISO_TEXTS]


def test_parse_iso_does_not_depend_on_the_session_zone(spark, zone):
    test_parse_iso(spark)


def _stamps(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )


@pytest.mark.parametrize(
    "minutes, expected",
    [
        (1, "2025-03-09T02:37"),
        (15, "2025-03-09T02:30"),
        (20, "2025-03-09T02:20"),
        (60, "2025-03-09T02:00"),
        (1440, "2025-03-09T00:00"),
    ],
)
def test_bins_are_counted_from_the_epoch_in_any_zone(spark, zone, minutes, expected):
    frame = _stamps(spark, "2025-03-09 02:37:45.5")
    assert rows(frame.select(bin_start("t", minutes))) == [(at(expected),)]
    packed = frame.select(numbered_bin_start(bin_number("t", minutes), minutes))
    assert rows(packed) == [(at(expected),)]


def test_bins_before_the_epoch(spark):
    frame = _stamps(spark, "1969-12-31 23:59:59")
    assert rows(frame.select(bin_start("t", 60))) == [(at("1969-12-31T23:00"),)]
    packed = frame.select(numbered_bin_start(bin_number("t", 60), 60))
    assert rows(packed) == [(at("1969-12-31T23:00"),)]


def test_bin_width_must_be_positive():
    with pytest.raises(ValueError):
        bin_start("t", 0)


@pytest.mark.parametrize(
    "text, label, monday, index",
    [
        ("2024-12-30", "2025W01", "2024-12-30", 1),
        ("2021-01-03", "2020W53", "2020-12-28", 7),
        ("2025-12-03", "2025W49", "2025-12-01", 3),
    ],
)
def test_iso_weeks_across_new_year(spark, zone, text, label, monday, index):
    frame = _stamps(spark, text + " 23:59:59")
    row = frame.select(
        week_label(iso_year("t"), iso_week("t")), week_start("t").cast("string"), day_index("t")
    ).first()
    assert tuple(row) == (label, monday, index)


def test_labels_and_hours(spark, zone):
    frame = _stamps(spark, "2025-03-05 06:45:36")
    day = F.col("t").cast("date")
    assert tuple(frame.select(day_label(day), hours_since_midnight("t")).first()) == ("05. Mar.", 6.76)


NUMBERS = [
    ("1.5", 1.5),
    ("-3", -3.0),
    ("1e3", 1000.0),
    ("true", 1.0),
    ("false", 0.0),
    ('" 1.5 "', 1.5),
    ('"1_000"', 1000.0),
    ('"1_0.5e1_0"', 10.5e10),
    ('".5"', 0.5),
    ('"5."', 5.0),
    ('"+7"', 7.0),
    ('"inf"', math.inf),
    ('"-Infinity"', -math.inf),
    ("NaN", math.nan),
    ('"nan"', math.nan),
    ('"-NaN"', math.nan),
    ('"1.5f"', None),
    ('"1d"', None),
    ('"0x10"', None),
    ('"0x1p3"', None),
    ('"1__0"', None),
    ('"_1"', None),
    ('"1_"', None),
    ('"true"', None),
    ('""', None),
    ('"a"', None),
    ("null", None),
    ("{}", None),
    ("[1]", None),
]


def test_document_float(spark):
    frame = spark.createDataFrame([(f'{{"v": {t}}}',) for t, _ in NUMBERS], "t string")
    doc = frame.select(F.from_json("t", "variant").alias("doc"))
    got = [r[0] for r in doc.select(document_float("doc", "$.v").alias("v")).collect()]
    for (text, expected), value in zip(NUMBERS, got, strict=True):
        if expected is not None and math.isnan(expected):
            assert value is not None and math.isnan(value), text
        elif expected is None:
            assert value is None, text
        else:
            assert value == pytest.approx(expected, rel=1e-6), text


@pytest.mark.parametrize(
    "line, expected",
    [
        ('{"time": {"datetime": "x"}, "S7": {"s": 1}}', False),
        ('{"S7": {"s": "1"}}', True),
        ('{"S7": {"\\u0073": 1}}', True),
    ],
)
def test_quoted_readings_are_found(spark, line, expected):
    frame = spark.createDataFrame([(line,)], "t string")
    assert rows(frame.select(has_quoted_reading(F.col("t")))) == [(expected,)]


def test_threshold_is_compared_in_single_precision(spark):
    frame = spark.sql("SELECT cast(0.08 AS float) AS a")
    assert rows(frame.select(at_or_above(F.col("a"), 0.08))) == [(True,)]
