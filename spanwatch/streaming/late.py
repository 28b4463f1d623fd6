"""Late rows of a stream as rows of a table, not as a count.

A stream is first received: every batch is written once, each row with whether its bin
was closed when it came, and the greatest time seen so far is kept beside the batch. The
binned means then read the received rows that were not late. These are never late there
either, as their watermark only knows rows that were received before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spanwatch.functions import bin_number, numbered_bin_start
from spanwatch.sources.store import remove_path


def received_path(base: str) -> str:
    return f"{base}/received"


def _mark_path(base: str, batch: int) -> str:
    return f"{base}/greatest/ingest_batch={batch}"


def _mark(spark: SparkSession, base: str, batch: int) -> tuple | None:
    """The greatest time up to a batch, as a row; None if the batch is not whole."""
    try:
        return spark.read.schema("greatest timestamp_ntz").parquet(_mark_path(base, batch)).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _receive(rows: DataFrame, batch: int, base: str, minutes: int, delay) -> None:
    """Write one batch and its mark; a batch that is whole is left alone when run again."""
    spark = rows.sparkSession
    if _mark(spark, base, batch) is not None:
        return
    before = _mark(spark, base, batch - 1)
    greatest = before[0] if before is not None else None
    known = F.lit(greatest).cast("timestamp_ntz")
    ends = numbered_bin_start(bin_number("datetime", minutes) + 1, minutes)
    closed = ends <= known - delay
    late = F.coalesce(closed, F.lit(False))
    path = f"{received_path(base)}/ingest_batch={batch}"
    rows.withColumn("late", late).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("late").parquet(path)
    seen = spark.read.schema("datetime timestamp_ntz").parquet(path).agg(F.greatest(F.max("datetime"), known).alias("greatest"))
    seen.coalesce(1).write.mode("overwrite").parquet(_mark_path(base, batch))
    # Each mark holds all that came before it, so two are enough.
    remove_path(spark, _mark_path(base, batch - 2))


def stream_receive(stream: DataFrame, base: str, checkpoint: str, minutes: int = 1, delay_minutes: int = 60) -> StreamingQuery:
    """Write the rows of a stream below ``base`` as they come, late ones marked.

    A row is late if its bin of ``minutes`` ended ``delay_minutes`` or more before the
    greatest time of earlier batches. Rows without a time are never late here and fall
    out of the bins. The query ends when the present rows are done and goes on when it
    is started again with the same checkpoint.
    """
    delay = F.make_dt_interval(mins=F.lit(int(delay_minutes)))

    def write(rows: DataFrame, batch: int) -> None:
        _receive(rows, batch, base, minutes, delay)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _schema(columns: T.StructType) -> T.StructType:
    return T.StructType([*columns.fields, T.StructField("ingest_batch", T.IntegerType()), T.StructField("late", T.BooleanType())])


def late_rows(spark: SparkSession, base: str, columns: T.StructType) -> DataFrame:
    """The late rows received so far."""
    received = spark.read.schema(_schema(columns)).parquet(received_path(base))
    return received.where("late").select(*columns.names)


def on_time(spark: SparkSession, base: str, columns: T.StructType) -> DataFrame:
    """The received rows that were not late, as a stream for ``stream_accel_minute`` and
    ``stream_means`` with the same bins and delay."""
    received = spark.readStream.schema(_schema(columns)).parquet(received_path(base))
    return received.where("NOT late").select(*columns.names)
