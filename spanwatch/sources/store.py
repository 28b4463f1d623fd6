"""Weekly tables on disk: one folder per table, partitioned by ISO year and week.

``append_chunks`` adds files as they come, without a shuffle. ``merge_weeks``
rewrites whole weeks sorted by time; running it twice leaves the same rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.functions import iso_week, iso_year
from spanwatch.model import TABLE_KEYS, table_schema

WEEK = ["iso_year", "iso_week"]


def table_path(base: str, key: str) -> str:
    """Folder of a weekly table; the four spectrum tables share one, split by hub."""
    if key not in TABLE_KEYS:
        raise ValueError(f"unknown table {key!r}; expected one of {TABLE_KEYS}")
    if key.startswith("fft_"):
        return f"{base}/fft/hub={key.removeprefix('fft_')}"
    return f"{base}/{key}"


def with_week(frame: DataFrame) -> DataFrame:
    return frame.withColumn("iso_year", iso_year("datetime")).withColumn(
        "iso_week", iso_week("datetime")
    )


def append_chunks(rows: DataFrame, path: str, partitions: list[str] = WEEK) -> None:
    """Add rows as new files. Each task writes what it holds; nothing is shuffled."""
    rows.write.mode("append").partitionBy(*partitions).option("compression", "zstd").parquet(path)


def merge_weeks(rows: DataFrame, path: str, partitions: list[str] = WEEK) -> None:
    """Replace the weeks present in ``rows`` by files sorted by time.

    The rebalance brings a week together in as few files as its size allows and
    splits one that is too large for a task, so a week holding most of the data is
    written by many tasks. Sorted files give tight time ranges per row group.
    """
    (
        rows.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, F.col("datetime").asc_nulls_last())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(path)
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunk files of a table; a column some files lack is null there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_table(spark: SparkSession, base: str, key: str, weeks: bool = False) -> DataFrame:
    """A weekly table, empty with the right columns if nothing was ever written.

    ``weeks`` keeps the partition columns, so a filter on them skips folders.
    """
    fields = table_schema(key).fields + [T.StructField(name, T.IntegerType()) for name in WEEK]
    schema = T.StructType(fields)
    wanted = schema.names if weeks else table_schema(key).names
    try:
        return spark.read.schema(schema).parquet(table_path(base, key)).select(wanted)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).select(wanted)


def read_tables(spark: SparkSession, base: str, weeks: bool = False) -> dict[str, DataFrame]:
    """All weekly tables; with ``weeks``, windows over them open only their weeks."""
    return {key: read_table(spark, base, key, weeks) for key in TABLE_KEYS}


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def replace_weeks(rows: DataFrame, path: str, touched: list[tuple[int, int]], partitions: list[str] = WEEK) -> None:
    """As :func:`merge_weeks`, and empty those of the ``touched`` weeks without rows.

    ``touched`` are the weeks of a run, a list the calendar bounds. Partition columns
    before the week, such as the hub, are looked up in the table's folders. Every write
    gives its files names of their own, so a folder that still holds the same files has
    no rows in ``rows``, which are not computed a second time to tell.
    """
    before = _week_files(rows.sparkSession, path, touched, partitions)
    merge_weeks(rows, path, partitions)
    for folder, names in _week_files(rows.sparkSession, path, touched, partitions).items():
        if names == before.get(folder):
            remove_path(rows.sparkSession, folder)


def _week_files(spark: SparkSession, path: str, weeks: list[tuple[int, int]], partitions: list[str]) -> dict[str, set[str]]:
    """The folders of some weeks and the names of the files in them."""
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    above = "/".join(f"{name}=*" for name in partitions if name not in WEEK)
    found = {}
    for year, week in weeks:
        pattern = "/".join(p for p in (path, above, f"iso_year={year}", f"iso_week={week}") if p)
        for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)) or []:
            held = files.listStatus(status.getPath())
            found[status.getPath().toString()] = {f.getPath().getName() for f in held}
    return found


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame that starts no Python worker."""
    return spark.range(0).select(F.from_json(F.lit(None).cast("string"), schema).alias("r")).select("r.*")


def empty_table(spark: SparkSession, key: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(key))


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Make every table queryable by its key in Spark SQL; returns the view names."""
    names = []
    for key, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{key}")
        names.append(f"{prefix}{key}")
    return names


def file_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Files below the paths with their row counts, from the file footers."""
    counts = None
    for path in paths:
        rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"))
        counts = rows if counts is None else counts.unionAll(rows)
    counts = counts.groupBy("path").agg(F.count("*").alias("n_rows"))
    return counts.select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "n_rows")


def describe_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns and types of each table, with its row count."""
    described = None
    for key, frame in tables.items():
        fields = [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
            )
            for i, f in enumerate(frame.schema.fields, start=1)
        ]
        rows = frame.agg(F.count("*").alias("n_rows")).select(
            F.lit(key).alias("table_key"), F.explode(F.array(*fields)).alias("f"), "n_rows"
        )
        rows = rows.select("table_key", "f.*", "n_rows")
        described = rows if described is None else described.unionByName(rows)
    return described


def rows_per_week(tables: dict[str, DataFrame], weeks: DataFrame) -> DataFrame:
    """Row count of every table in every week of ``weeks``, zero where it has none.

    ``weeks`` has one row per ISO week. The zero rows are the weeks for which a
    table is empty but still readable.
    """
    counted = None
    for key, frame in tables.items():
        per_week = (
            with_week(frame.where(F.col("datetime").isNotNull()).select("datetime"))
            .groupBy(*WEEK)
            .agg(F.count("*").alias("n"))
            .withColumn("table_key", F.lit(key))
        )
        counted = per_week if counted is None else counted.unionByName(per_week)
    keys = F.array(*[F.lit(key) for key in tables])
    spine = weeks.select(*WEEK, F.explode(keys).alias("table_key")).withColumn("n", F.lit(0))
    return (
        counted.unionByName(spine)
        .groupBy("table_key", *WEEK)
        .agg(F.sum("n").cast("long").alias("n_rows"))
    )


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column one of them lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def union_append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows followed by new ones, columns matched by position."""
    return existing.union(new)
