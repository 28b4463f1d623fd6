"""Row numbers over a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwatch.llm.scratch import stored

_SHIFT = 33


def numbered(frame: DataFrame, order: list[str], column: str = "row", keep: list[str] | None = None) -> DataFrame:
    """``frame``, or its columns ``keep``, with ``column``: 0, 1, 2, ... in the given order.

    Rows are dealt by range, sorted in their partition and written; the offset of a
    partition is the sum of the counts before it (one row per partition). The numbers
    depend on the order alone, not on where the ranges were cut; rows that are equal
    in ``order`` share their numbers in any way.
    """
    spark = frame.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = frame.repartitionByRange(width, *order).sortWithinPartitions(*order)
    if keep is not None:
        dealt = dealt.select(*keep)
    placed = stored(dealt.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", _SHIFT)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per partition of the sort: a size the session sets, not the data.
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    inside = F.col("_place") - F.shiftleft(F.col("_part").cast("long"), _SHIFT)
    return joined.withColumn(column, F.col("_before") + inside).drop("_part", "_place", "_before")
