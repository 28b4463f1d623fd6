"""Raw sensor documents: one JSON object per line."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.functions import day_index, iso_week, iso_year, week_label

STAMP_PATH = "$.time.datetime"


def read_documents(spark: SparkSession, path: str, format: str = "text", **options) -> DataFrame:
    """Lines of JSON as one ``value`` column.

    ``format`` may name any connector on the classpath. A connector that returns
    typed columns is turned into the same one-line form.
    """
    frame = spark.read.format(format).options(**options).load(path)
    if format == "text":
        return frame.select("value")
    return as_json_lines(frame)


def as_json_lines(frame: DataFrame) -> DataFrame:
    """Typed rows to JSON lines; types JSON lacks are written as text."""
    return frame.select(F.to_json(F.struct("*")).alias("value"))


def with_stamp(documents: DataFrame) -> DataFrame:
    """Add ``doc`` (parsed, null if the line is broken) and its ``stamp`` text."""
    return documents.withColumn("doc", F.from_json("value", "variant")).withColumn(
        "stamp", F.try_variant_get("doc", STAMP_PATH, "string")
    )


def emit_when(frame: DataFrame, condition: Column, row: Column, name: str = "row") -> DataFrame:
    """Keep the rows that meet ``condition``, without evaluating the line twice.

    A plain filter would be moved below the projection that parses the line and
    parse it a second time; a generator that emits one row or none is not moved.
    """
    return frame.select(F.explode(F.when(condition, F.array(row))).alias(name))


def scan_range(documents: DataFrame, start: str, end: str) -> DataFrame:
    """Documents with ``start <= time.datetime < end``, compared as text.

    The text is compared before it is parsed, so an offset inside it never moves a
    document into another week.
    """
    stamped = with_stamp(documents)
    inside = (F.col("stamp") >= start) & (F.col("stamp") < end)
    kept = emit_when(stamped, inside, F.struct("stamp", "value"))
    return kept.select("row.stamp", "row.value")


def keep_week(documents: DataFrame, year: int, week: int) -> DataFrame:
    """Lines that state a time in the week, and lines that are not JSON: these may
    belong to any week. Nothing else of a line is read."""
    start, end = week_range(year, week)
    stamped = with_stamp(documents)
    inside = (F.col("stamp") >= start) & (F.col("stamp") < end)
    broken = F.expr("doc IS NULL AND trim(value) <> ''")
    return emit_when(stamped, F.coalesce(inside, F.lit(False)) | broken, F.struct("value")).select("row.value")


def week_range(year: int, week: int) -> tuple[str, str]:
    """ISO texts of Monday 00:00 and the Monday after."""
    monday = date.fromisocalendar(year, week, 1)
    return f"{monday}T00:00:00", f"{monday + timedelta(days=7)}T00:00:00"


def previous_week(today: date) -> tuple[int, int]:
    """ISO year and week before the one of ``today``, also across new year."""
    parts = (today - timedelta(days=7)).isocalendar()
    return parts.year, parts.week


def scan_week(documents: DataFrame, year: int, week: int) -> DataFrame:
    return scan_range(documents, *week_range(year, week))


def day_slices(documents: DataFrame) -> DataFrame:
    """Every document with the name of its day slice, ``2025W49_1`` for a Monday.

    The day is read off the text's first ten characters, as the range scan does.
    Documents without a readable day are left out.
    """
    stamped = with_stamp(documents).withColumn(
        "day", F.substring("stamp", 1, 10).try_cast("date")
    )
    kept = emit_when(stamped, F.col("day").isNotNull(), F.struct("day", "stamp", "value"))
    day = F.col("row.day")
    label = F.concat_ws(
        "_", week_label(iso_year(day), iso_week(day)), day_index(day).cast("string")
    )
    return kept.select(label.alias("slice"), day.alias("day"), "row.stamp", "row.value")


def export_day_slices(documents: DataFrame, path: str) -> None:
    """Write one folder of JSON lines per day slice, replacing the days written.

    Days are brought together before, in as few files as their size allows."""
    (
        day_slices(documents)
        .select("slice", "value")
        .hint("rebalance", "slice")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slice")
        .text(path)
    )


def read_day_slices(spark: SparkSession, path: str, first: date, last: date | None = None) -> DataFrame:
    """Lines of the exported days from ``first`` to ``last`` (one day if not given).

    Only the folders of these days are opened; a day without a folder has no lines.
    """
    days = [first + timedelta(days=n) for n in range(((last or first) - first).days + 1)]
    names = ["{}W{:02d}_{}".format(*day.isocalendar()) for day in days]
    slices = spark.read.schema("value string, slice string").text(path)
    return slices.where(F.col("slice").isin(names)).select("value")


def read_week_slices(spark: SparkSession, path: str, year: int, week: int) -> DataFrame:
    """Lines of the exported days of one ISO week."""
    monday = date.fromisocalendar(year, week, 1)
    return read_day_slices(spark, path, monday, monday + timedelta(days=6))


def count_day_slices(documents: DataFrame) -> DataFrame:
    """Number of documents per day slice."""
    return day_slices(documents).groupBy("slice", "day").agg(F.count("*").alias("n_documents"))


def sample_documents(documents: DataFrame, n: int = 1, order: str | None = None) -> DataFrame:
    """``n`` documents for a look at their shape: any, or the first by a column."""
    if order is not None:
        documents = documents.orderBy(order)
    return documents.limit(n)
