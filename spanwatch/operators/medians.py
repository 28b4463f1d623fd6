"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Multiplying by 2**41 + 1 and subtracting back leaves 12 of a double's 53
# significant bits. Rounding never reverses an order, and single-precision values
# fall into at most about 1.1 million classes (a few thousand for readings of one
# magnitude) of at most 8,192 values each.
_SPLIT = float(2**41 + 1)

def coarse_class(value: Column) -> Column:
    """Value rounded to 12 significant bits; not-a-number and infinities as they are.

    Nulls, which never count, share the lowest class."""
    value = value.cast("double")
    scaled = value * F.lit(_SPLIT)
    finite = F.abs(value) < F.lit(float("inf"))
    rounded = F.when(finite, scaled - (scaled - value)).otherwise(value)
    return F.coalesce(rounded, F.lit(float("-inf")))


def _same(rows: DataFrame, left: str, right: str, columns: list[str]) -> Column:
    """Equality of columns; null-safe only where null can occur, as that costs the join."""
    condition = F.lit(True)
    for name in columns:
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        condition = condition & (a.eqNullSafe(b) if rows.schema[name].nullable else a == b)
    return condition


def value_counts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Values of each group and how often they occur, with their coarse class. Counting
    combines before the shuffle and spreads a group over all tasks."""
    rows = rows.select(*keys, F.col(value).cast("float").alias("_v"))
    rows = rows.withColumn("_class", coarse_class(F.col("_v")))
    return rows.groupBy(*keys, "_class", "_v").agg(F.count("_v").alias("_n"))


def exact_median(rows: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Median of a single-precision column per group; null for a group of nulls.

    ``percentile`` keeps all values of a group in one task. Here values are counted,
    the counts by coarse class tell which class holds the middle, and only that class is
    ranked. No step holds more of a group than the limits stated above, however many
    rows it has, and the plan is the same for any number of groups.
    """
    return median_of_counts(value_counts(rows, keys, value), keys, name)


def median_of_counts(counted: DataFrame, keys: list[str], name: str = "median", mean: str | None = None) -> DataFrame:
    """Median per group from its value counts, and the mean if it is given a name."""
    value = F.col("_v").cast("double")
    classes = counted.groupBy(*keys, "_class").agg(F.sum("_n").alias("_n"), F.sum(value * F.col("_n")).alias("_sum"))
    middle = _middle_classes(classes, keys, mean)
    inside = (
        counted.alias("l")
        .join(middle.alias("r"), _same(counted, "l", "r", [*keys, "_class"]))
        .select("l.*", "r._lower", "r._upper", *(["r._mean"] if mean else []))
    )
    return _ranked(inside, keys, name, mean)


def median_of_rows(
    rows: DataFrame, keys: list[str], value: str, name: str = "median", mean: str | None = None, keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """As :func:`median_of_counts`, from rows that are read twice: once to count the coarse
    classes, and once for the values of the middle ones, so most values are never shuffled.
    The rows of a group should lie together, as counting combines within a task. ``keep``
    may write the middle classes and read them back: their size, one or two rows a group,
    is then known when their join with the rows is planned."""
    rows = rows.select(*keys, F.col(value).cast("float").alias("_v"))
    rows = rows.withColumn("_class", coarse_class(F.col("_v")))
    classes = rows.groupBy(*keys, "_class").agg(F.count("_v").alias("_n"), F.sum(F.col("_v").cast("double")).alias("_sum"))
    middle = _middle_classes(classes, keys, mean)
    middle = keep(middle) if keep else middle
    carried = ["_lower", "_upper", *(["_mean"] if mean else [])]
    met = rows.alias("l").join(middle.alias("r"), _same(rows, "l", "r", [*keys, "_class"])).select("l.*", *[f"r.{c}" for c in carried])
    return _ranked(met.groupBy(*keys, "_class", "_v", *carried).agg(F.count("_v").alias("_n")), keys, name, mean)


def _holds(rank: Column, before: Column) -> Column:
    return (before < rank) & (rank <= F.col("_upto"))


def _middle_classes(classes: DataFrame, keys: list[str], mean: str | None) -> DataFrame:
    """The classes with the middle of each group, and its ranks counted from their start."""
    group = W.partitionBy(*keys)
    classes = classes.select(
        *keys,
        "_class",
        "_n",
        F.sum("_n").over(group.orderBy("_class")).alias("_upto"),
        F.sum("_n").over(group).alias("_total"),
        *([F.sum("_sum").over(group).alias("_all")] if mean else []),
    )
    before = F.col("_upto") - F.col("_n")
    total = F.col("_total")
    lower, upper = F.floor((total + 1) / 2), F.floor(total / 2) + 1

    carried = [F.when(total > 0, F.col("_all") / total).alias("_mean")] if mean else []
    return classes.where(_holds(lower, before) | _holds(upper, before) | (total == 0)).select(
        *keys, "_class", (lower - before).alias("_lower"), (upper - before).alias("_upper"), *carried
    )


def _ranked(inside: DataFrame, keys: list[str], name: str, mean: str | None) -> DataFrame:
    """Median per group from the counted values of its middle classes."""
    upto = F.sum("_n").over(W.partitionBy(*keys, "_class").orderBy("_v"))
    before = F.col("_upto") - F.col("_n")
    found = (
        inside.withColumn("_upto", upto)
        .groupBy(*keys)
        .agg(
            F.max(F.when(_holds(F.col("_lower"), before), F.col("_v"))).alias("_a"),
            F.max(F.when(_holds(F.col("_upper"), before), F.col("_v"))).alias("_b"),
            *([F.max("_mean").alias(mean)] if mean else []),
        )
    )
    a, b = F.col("_a").cast("double"), F.col("_b").cast("double")
    return found.select(*keys, ((a + b) / 2).cast("float").alias(name), *([mean] if mean else []))
