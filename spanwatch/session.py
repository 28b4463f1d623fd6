"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Zone-free timestamps carry all times; the zone only decides how text is cast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "spanwatch", **extra: str) -> SparkSession:
    """Session with the settings above; master and sizes come from the cluster."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else the warehouse.

    A warehouse on the driver's own disk will do for a local master only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    alone = spark.conf.get("spark.master", "local").startswith("local")
    if not alone and (warehouse.startswith("file:") or ":" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/spanwatch/{name}-{uuid.uuid4().hex}"
