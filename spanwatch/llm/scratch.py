"""Written intermediates: lineage ends at a table every executor can read again."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from spanwatch.session import scratch_path


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.mode("errorifexists").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete a table made by :func:`stored` that no later plan reads."""
    spark = frame.sparkSession
    for path in {p.rsplit("/", 1)[0] for p in frame.inputFiles()}:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps, which it does when the
    driver's objects for them are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
