import glob

import pytest
from helpers import at, rows, table, tables

from spanwatch.model import TABLE_KEYS, table_schema
from spanwatch.operators.timewindow import week_spine, week_spine_between
from spanwatch.sources.store import (
    append_chunks,
    describe_tables,
    empty_table,
    file_inventory,
    merge_weeks,
    read_chunks,
    read_table,
    read_tables,
    register_views,
    rows_per_week,
    table_path,
    union_append,
    union_by_name,
    with_week,
)


def week49(spark, value=1.0):
    return table(
        spark,
        "sst_hub3",
        [{"datetime": at(f"2025-12-0{d}T00:00:00"), "S15": value + d} for d in (3, 1, 2)],
    )


def test_unwritten_tables_are_empty_with_their_columns(spark, tmp_path):
    for key, frame in read_tables(spark, str(tmp_path)).items():
        assert frame.count() == 0
        assert frame.schema == table_schema(key) == empty_table(spark, key).schema


def test_merging_twice_leaves_the_same_rows(spark, tmp_path):
    base = str(tmp_path)
    path = table_path(base, "sst_hub3")
    for _ in range(2):
        merge_weeks(with_week(week49(spark)), path)
    assert rows(read_table(spark, base, "sst_hub3").select("S15"), "S15") == [(2.0,), (3.0,), (4.0,)]


def test_merging_a_week_leaves_other_weeks_alone(spark, tmp_path):
    base = str(tmp_path)
    path = table_path(base, "sst_hub3")
    other = table(spark, "sst_hub3", [{"datetime": at("2025-11-30"), "S15": 9.0}])
    merge_weeks(with_week(week49(spark).unionByName(other)), path)
    merge_weeks(with_week(week49(spark, 10.0)), path)
    got = read_table(spark, base, "sst_hub3", weeks=True).select("iso_week", "S15")
    assert rows(got, "S15") == [(48, 9.0), (49, 11.0), (49, 12.0), (49, 13.0)]


def test_merged_files_are_sorted_by_time_nulls_last(spark, tmp_path):
    path = str(tmp_path / "t")
    late = table(spark, "sst_hub3", [{"datetime": None, "S15": 0.0}])
    frame = week49(spark).unionByName(late).selectExpr("*", "2025 AS iso_year", "49 AS iso_week")
    merge_weeks(frame, path)
    (file,) = glob.glob(f"{path}/iso_year=2025/iso_week=49/*.parquet")
    stamps = [r[0] for r in spark.read.parquet(file).select("datetime").collect()]
    assert stamps == [at("2025-12-01"), at("2025-12-02"), at("2025-12-03"), None]


def test_chunks_of_different_columns_are_read_by_name(spark, tmp_path):
    path = str(tmp_path / "chunks")
    append_chunks(with_week(week49(spark)).drop("S16"), path)
    append_chunks(with_week(week49(spark, 5.0)).drop("T2"), path)
    chunks = read_chunks(spark, path)
    assert chunks.count() == 6
    assert {"S16", "T2"} <= set(chunks.columns)


def test_weeks_prune_folders(spark, tmp_path):
    base = str(tmp_path)
    merge_weeks(with_week(week49(spark)), table_path(base, "sst_hub3"))
    frame = read_table(spark, base, "sst_hub3", weeks=True).where("iso_year = 2025 AND iso_week = 49")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "iso_week" in filters and "iso_year" in filters


def test_the_spectrum_tables_share_a_folder_by_hub():
    assert table_path("b", "fft_hub2") == "b/fft/hub=hub2"
    assert table_path("b", "accel_all") == "b/accel_all"
    with pytest.raises(ValueError):
        table_path("b", "sst_hub9")


def test_views(spark):
    names = register_views(tables(spark, accel_all=[{"datetime": at("2025-12-01")}]), "t_")
    assert names == [f"t_{k}" for k in TABLE_KEYS]
    assert spark.sql("SELECT count(*) FROM t_accel_all").first()[0] == 1
    assert {t.name for t in spark.catalog.listTables()} >= set(names)


def test_inventory_counts_rows_per_file(spark, tmp_path):
    path = str(tmp_path / "a.parquet")
    week49(spark).coalesce(1).write.parquet(path)
    (row,) = rows(file_inventory(spark, path))
    assert row[0].endswith(".parquet") and row[2] == 3


def test_describe(spark):
    got = rows(describe_tables({"sst_hub3": week49(spark)}), "position")
    assert got[0] == ("sst_hub3", 1, "datetime", "timestamp_ntz", 3)
    assert got[-1] == ("sst_hub3", 6, "T2", "float", 3)


def test_weeks_without_rows_are_listed_with_zero(spark):
    given = {"sst_hub3": [{"datetime": at("2025-12-01")}, {"datetime": at("2025-12-16")}]}
    frames = tables(spark, **given)
    got = rows_per_week(frames, week_spine(frames["sst_hub3"]))
    assert got.count() == 9 * 3
    hub3 = rows(got.where("table_key = 'sst_hub3'"), "iso_week")
    assert [(r[2], r[3]) for r in hub3] == [(49, 1), (50, 0), (51, 1)]


def test_unions(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS y")
    assert rows(union_by_name(a, b), "y") == [(1, 2), (None, 3)]
    assert rows(union_append(a, spark.sql("SELECT 3 AS y, 4 AS x")), "x") == [(1, 2), (3, 4)]


def test_week_spine_has_every_week_across_years(spark):
    spine = rows(week_spine_between(spark, (2024, 35), (2025, 49)), "monday")
    assert len(spine) == 67
    labels = [r[2] for r in spine]
    assert labels[0] == "2024W35" and labels[-1] == "2025W49"
    assert labels[17:19] == ["2024W52", "2025W01"]
    assert str(spine[-1][4]) == "2025-12-07" and str(spine[-1][5]) == "2025-12-08"
