"""Weekly ingest: documents to the sorted weekly tables, each line parsed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.model import HUBS
from spanwatch.operators.flatten import accel_rows, fft_rows, parse_documents, placed, quarantine, sst_rows
from spanwatch.operators.readings import SCHEMA, read_readings
from spanwatch.session import scratch_path
from spanwatch.sources.documents import keep_week
from spanwatch.sources.statistics import update_statistics
from spanwatch.sources.store import WEEK, remove_path, replace_weeks

# Folder of each family below the base folder, and how it is partitioned.
FAMILY_PARTITIONS = {
    "accel_all": WEEK,
    "fft": ["hub", *WEEK],
    **{f"sst_{hub}": WEEK for hub in HUBS},
}


def stage(documents: DataFrame, path: str) -> DataFrame:
    """Parse every line once and keep the typed rows at ``path``.

    The families are then read from columns of that table. It survives the loss of
    executors, unlike a cache. Plain documents are read in batches; the lines of the
    others are kept beside them and parsed one by one.
    """
    spark = documents.sparkSession
    rows = placed(read_readings(documents))
    rows.write.parquet(f"{path}/plain")
    read = spark.read.schema(rows.schema).parquet(f"{path}/plain")
    others = parse_documents(read.where(F.col("line").isNotNull()).select(F.col("line").alias("value")))
    others.write.parquet(f"{path}/others")
    others = spark.read.schema(others.schema).parquet(f"{path}/others")
    plain = read.where(F.col("line").isNull())
    spectra = F.array().cast(others.schema["fft"].dataType)
    return plain.select("*", spectra.alias("fft"), F.col("line").alias("broken")).drop("line").unionByName(others)


def family_frames(parsed: DataFrame) -> dict[str, DataFrame]:
    """Rows of each family with the ISO week written in the document."""
    frames = {"accel_all": accel_rows(parsed, WEEK), "fft": fft_rows(parsed, WEEK)}
    for hub in HUBS:
        frames[f"sst_{hub}"] = sst_rows(parsed, hub, WEEK)
    return frames


def weeks_of(parsed: DataFrame) -> list[tuple[int, int]]:
    """Weeks the documents state; the calendar bounds their number."""
    rows = parsed.where(F.col("iso_year").isNotNull()).select(*WEEK).distinct().collect()
    return [tuple(r) for r in rows]


def ingest(spark: SparkSession, documents: DataFrame, base: str, run: str = "all") -> None:
    """Replace the weeks the documents touch in all weekly tables.

    The documents must hold these weeks completely: a table is emptied for a week it
    has no rows for. Documents that cannot be placed in time replace the ``quarantine``
    of the run of that name.
    """
    _write(spark, documents, base, run, None)


def ingest_week(spark: SparkSession, documents: DataFrame, base: str, year: int, week: int) -> None:
    """Replace one ISO week in all weekly tables; other documents are not parsed.

    Lines that are not JSON may belong to any week and go to this run's quarantine.
    """
    _write(spark, keep_week(documents, year, week), base, f"{year}W{week:02d}", [(year, week)])


def _write(spark: SparkSession, documents: DataFrame, base: str, run: str, weeks: list[tuple[int, int]] | None) -> None:
    path = scratch_path(spark, "parsed")
    try:
        parsed = stage(documents, path)
        touched = weeks_of(parsed) if weeks is None else weeks
        for family, rows in family_frames(parsed).items():
            replace_weeks(rows, f"{base}/{family}", touched, FAMILY_PARTITIONS[family])
        update_statistics(spark, base, touched)
        write_quarantine(parsed, base, run)
    finally:
        remove_path(spark, path)


def write_quarantine(parsed: DataFrame, base: str, run: str) -> None:
    """Set the quarantined documents of one run, whatever an earlier try left."""
    quarantine(parsed).write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/quarantine/run={run}")
