import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanwatch.operators.medians import coarse_class, exact_median, median_of_rows


def medians(spark, data):
    frame = spark.createDataFrame(data, "g string, v float")
    return {r.g: r.median for r in exact_median(frame, ["g"], "v").collect()}


def test_odd_even_ties_and_nulls(spark):
    data = [("odd", v) for v in (3.0, 1.0, 2.0)]
    data += [("even", v) for v in (1.0, 2.0, 4.0, 100.0)]
    data += [("ties", v) for v in (5.0, 5.0, 5.0, 9.0)]
    data += [("holes", None), ("holes", 7.0), ("holes", None)]
    data += [("empty", None), ("empty", None), ("one", -0.5), (None, 8.0)]
    expected = {"odd": 2.0, "even": 3.0, "ties": 5.0, "holes": 7.0, "empty": None, "one": -0.5, None: 8.0}
    assert medians(spark, data) == expected


def test_not_a_number_ranks_last_and_infinities_at_the_ends(spark):
    inf, nan = math.inf, math.nan
    got = medians(
        spark,
        [("a", v) for v in (1.0, nan, 2.0)]
        + [("b", v) for v in (nan, nan, 2.0)]
        + [("c", v) for v in (-inf, 5.0, inf)]
        + [("d", v) for v in (inf, inf, 1.0)],
    )
    assert got["a"] == 2.0 and math.isnan(got["b"]) and got["c"] == 5.0 and got["d"] == inf


def test_a_group_with_most_rows_and_values_close_together(spark):
    frame = spark.range(30000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("g"),
        (F.lit(41234.0) + F.pmod(F.col("id") * 7919, F.lit(10007)) / 256).cast("float").alias("v"),
    )
    got = {r.g: r.median for r in exact_median(frame, ["g"], "v").collect()}
    expected = frame.groupBy("g").agg(F.median("v").cast("float").alias("m")).collect()
    assert got == {r.g: r.m for r in expected}


def test_key_names_do_not_clash(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4.0)], "n int, c int, upto int, v float")
    assert [tuple(r) for r in exact_median(frame, ["n", "c", "upto"], "v").collect()] == [(1, 2, 3, 4.0)]


def test_classes_keep_the_order_of_values(spark):
    values = [-3.4e38, -1e30, -41.0, -1e-40, 0.0, 1e-45, 1e-38, 0.1, 0.100001, 41.0, 41.5, 3.4e38]
    frame = spark.createDataFrame([(v,) for v in values], "v float")
    classes = [r[0] for r in frame.orderBy("v").select(coarse_class(F.col("v"))).collect()]
    assert classes == sorted(classes)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.sampled_from("abcd"),
        st.lists(st.floats(width=32, allow_nan=False, allow_infinity=False, min_value=-(2.0**100), max_value=2.0**100), min_size=1, max_size=40),
        min_size=1,
    )
)
def test_equals_the_middle_of_the_sorted_list(spark, groups):
    data = [(g, v) for g, values in groups.items() for v in values]
    got = medians(spark, data)
    assert medians(spark, data) == got
    frame = spark.createDataFrame([(g, statistics.median(v)) for g, v in groups.items()], "g string, m double")
    assert got == {r.g: r.m for r in frame.select("g", F.col("m").cast("float").alias("m")).collect()}


def test_medians_of_rows_shuffle_middle_values_only(spark):
    data = [("holes", None), ("holes", 7.0), ("empty", None), (None, 8.0), (None, 9.0), ("nan", math.nan), ("nan", 1.0), ("zero", -0.0), ("zero", 0.0)]
    data += [("many", float(k * k % 1009) / 7) for k in range(500)]
    frame = spark.createDataFrame(data, "g string, v float")
    kept = []
    found = median_of_rows(frame, ["g"], "v", mean="mean", keep=lambda middle: kept.append(middle) or middle)
    got = {r.g: r for r in found.collect()}
    expected = {r.g: r.median for r in exact_median(frame, ["g"], "v").collect()}
    assert {g: str(r["median"]) for g, r in got.items()} == {g: str(m) for g, m in expected.items()}
    assert got["empty"]["mean"] is None and got[None]["mean"] == 8.5 and got["holes"]["mean"] == 7.0
    # One or two classes a group are what the rows are joined with.
    assert kept[0].count() <= 2 * len(expected)
