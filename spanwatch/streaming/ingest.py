"""Incremental ingest: new document files become chunk files of the weekly tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanwatch.llm.scratch import release
from spanwatch.plans.ingest import FAMILY_PARTITIONS, family_frames, stage, write_quarantine
from spanwatch.session import scratch_path
from spanwatch.sources.statistics import update_statistics
from spanwatch.sources.store import WEEK, merge_weeks, remove_path


def _write_batch(documents: DataFrame, batch: int, chunks: str) -> None:
    """Chunk files of one batch by week, in a folder of its own, and its quarantine.

    A batch that is run again after a failure replaces its own folder, so its rows
    are never written twice. The mark written last tells merges that it is whole.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "parsed")
    try:
        parsed = stage(documents, path)
        # A batch of repeated documents only has no rows to write.
        for family, rows in family_frames(parsed).items() if not parsed.isEmpty() else ():
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .option("compression", "zstd")
                .partitionBy(*WEEK)
                .parquet(f"{chunks}/{family}/ingest_batch={batch}")
            )
        write_quarantine(parsed, chunks, f"batch{batch}")
        mark = spark.range(1).select(F.lit(batch).cast("long").alias("batch"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{chunks}/written/ingest_batch={batch}")
    finally:
        remove_path(spark, path)
        # The lines a batch before this one was dealt by are as large as its files.
        release(spark)


def stream_ingest(
    spark: SparkSession,
    source: str,
    chunks: str,
    checkpoint: str,
    max_files: int | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Read the document files not seen so far and write their chunk files.

    The query stops when the present files are done and picks up the next ones when
    it is started again with the same checkpoint. Documents that cannot be placed in
    time go to ``quarantine`` beside the chunks.

    With ``repeats_within`` (such as ``"14 days"``) a document that arrives again, line
    for line, within that time of its first arrival is left out, whichever files and
    batches hold it. What is kept for that is a digest of each line for that long.
    Arrival is the time of the batch, which never goes back, so no document is late.
    """
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(source).select("value")
    if repeats_within is not None:
        digest = F.unhex(F.sha2("value", 256)).alias("digest")
        arrived = lines.select("value", digest, F.current_timestamp().alias("arrived"))
        lines = arrived.withWatermark("arrived", repeats_within).dropDuplicatesWithinWatermark(["digest"]).select("value")

    def write(batch: DataFrame, number: int) -> None:
        _write_batch(batch, number, chunks)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """Chunks or marks; None if there is nothing yet."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def merge_chunks(spark: SparkSession, chunks: str, base: str) -> list[tuple[int, int]]:
    """Bring the chunk files of new batches into the sorted weekly tables; returns the
    weeks that were written.

    Only weeks that a batch not merged before has rows in are written again, from all
    chunks of these weeks; their folders keep other weeks closed. Batches are numbered
    in order and one is only begun when the one before is whole, so the last merged
    number is all there is to remember. It is written once all families are done, so a
    merge that broke off is done again.
    """
    marks, written = _read(spark, f"{base}/merged_upto"), _read(spark, f"{chunks}/written")
    done = marks.agg(F.max("batch")).first()[0] if marks is not None else -1
    last = written.agg(F.max("batch")).first()[0] if written is not None else None
    if last is None or last <= done:
        return []
    every: set[tuple[int, int]] = set()
    for family, partitions in FAMILY_PARTITIONS.items():
        rows = _read(spark, f"{chunks}/{family}")
        if rows is None or "iso_year" not in rows.columns:
            continue
        whole = rows.where(F.col("ingest_batch") <= last)
        # The calendar bounds the weeks.
        weeks = [(r.iso_year, r.iso_week) for r in whole.where(F.col("ingest_batch") > done).select(*WEEK).distinct().collect()]
        if weeks:
            touched = whole.where((F.col("iso_year") * 100 + F.col("iso_week")).isin([y * 100 + w for y, w in weeks]))
            merge_weeks(touched.drop("ingest_batch"), f"{base}/{family}", partitions)
            every |= set(weeks)
    if every:
        update_statistics(spark, base, sorted(every))
    spark.range(1).select(F.lit(last).cast("long").alias("batch")).coalesce(1).write.mode("overwrite").parquet(f"{base}/merged_upto")
    # Marks of merged batches are not needed any more; the last one keeps the table.
    old = written.where(F.col("batch") < last).select("batch").collect()
    for row in old:
        remove_path(spark, f"{chunks}/written/ingest_batch={row.batch}")
    release(spark)
    return sorted(every)
