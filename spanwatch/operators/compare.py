"""Comparing two versions of the tables, and finding what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.functions import iso_week, iso_year, week_label, week_start
from spanwatch.model import ACCELEROMETERS, HUBS, sst_columns
from spanwatch.operators.timewindow import weeks_between
from spanwatch.sources.statistics import rows_digest
from spanwatch.sources.store import WEEK

Tables = dict[str, DataFrame]


def _unmatched(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Rows whose time the other table does not have, untimed rows included.

    The other side is reduced to its distinct times first. Untimed rows match
    nothing and are passed by the join, which would send them all to one task.
    """
    times = other.select("datetime").where(F.col("datetime").isNotNull()).distinct()
    timed = rows.where(F.col("datetime").isNotNull())
    untimed = rows.where(F.col("datetime").isNull())
    return timed.join(times, "datetime", "left_anti").select(rows.columns).unionByName(untimed)


def diff_full_outer(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows found in one version only, matched by time.

    The one-sided part of a full outer join, as two anti joins: these let a hot
    time be split over tasks, which a full outer join does not.
    """

    def side(rows: DataFrame, mine: str, other: str) -> DataFrame:
        values = [c for c in rows.columns if c != "datetime"]
        return rows.select(
            F.col("datetime").alias(f"{mine}_dt"),
            F.lit(None).cast("timestamp_ntz").alias(f"{other}_dt"),
            "datetime",
            *[F.col(c).alias(f"{mine}_{c}") for c in values],
        )

    only_new = side(_unmatched(new, old), "new", "old")
    only_old = side(_unmatched(old, new), "old", "new")
    return only_new.unionByName(only_old, allowMissingColumns=True)


def in_diff_order(diff: DataFrame) -> DataFrame:
    """New rows by time, then old rows by time; other columns break ties."""
    first = ["new_dt", "old_dt"]
    rest = [c for c in diff.columns if c not in first]
    return diff.orderBy(*[F.col(c).asc_nulls_last() for c in first + rest])


def diff_except(old: DataFrame, new: DataFrame) -> DataFrame:
    """Whole rows one version holds more often than the other, and how many copies more.

    Both versions are stacked and counted once; equal rows are combined before the
    shuffle, however many copies there are.
    """
    columns = new.columns
    stacked = new.withColumn("n", F.lit(1)).union(old.select(columns).withColumn("n", F.lit(-1)))
    surplus = stacked.groupBy(*columns).agg(F.sum("n").alias("n")).where(F.col("n") != 0)
    return surplus.select(
        F.when(F.col("n") > 0, "new").otherwise("old").alias("side"),
        *columns,
        F.abs("n").alias("copies"),
    )


def _millisecond_text(stamp: Column) -> Column:
    """A whole-millisecond time as text with three decimals."""
    text = stamp.cast("string")
    fraction = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 19), F.lit("."), fraction)


def timestamp_presence(stamps: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """For each distinct millisecond of the times in ``stamps``, its row count in both
    versions. Times are cut to milliseconds on every side."""

    def cut(rows: DataFrame) -> DataFrame:
        timed = rows.where(F.col("datetime").isNotNull())
        return timed.select(F.date_trunc("MILLISECOND", "datetime").cast("timestamp_ntz").alias("at"))

    def counts(rows: DataFrame, name: str) -> DataFrame:
        return cut(rows).groupBy("at").agg(F.count("*").alias(name))

    result = cut(stamps).distinct()
    for side in [counts(old, "exists_in_old"), counts(new, "exists_in_new")]:
        result = result.join(side, "at", "left")
    zero = F.lit(0).cast("long")
    return result.select(
        _millisecond_text(F.col("at")).alias("timestamp"),
        F.coalesce("exists_in_old", zero).alias("exists_in_old"),
        F.coalesce("exists_in_new", zero).alias("exists_in_new"),
    )


def lookup_times(stamps: DataFrame, frame: DataFrame) -> DataFrame:
    """Rows of a stored table whose time is, to the millisecond, one of ``stamps``.

    The table is read with its week columns. Weeks that none of the times can lie in are
    not opened: a document's offset may move its time by a day, so the weeks of a day
    before and after are looked at, a list the calendar bounds. In the others the files
    are sorted by time, and the bounds of the list skip the parts beyond it.
    """
    cut = F.date_trunc("MILLISECOND", "datetime").cast("timestamp_ntz")
    wanted = stamps.where(F.col("datetime").isNotNull()).select(cut.alias("at")).distinct()
    around = F.explode(F.array(*[F.col("at") + F.make_dt_interval(days=F.lit(d)) for d in (-1, 0, 1)])).alias("near")
    weeks = wanted.select(around).select((iso_year("near") * 100 + iso_week("near")).alias("filed")).distinct()
    low, high = wanted.agg(F.min("at")).scalar(), wanted.agg(F.max("at") + F.make_dt_interval(secs=F.lit(0.001).cast("decimal(18,6)"))).scalar()
    number = (F.col("iso_year") * 100 + F.col("iso_week")).alias("filed")
    rows = frame.where((F.col("datetime") >= low) & (F.col("datetime") < high)).select("*", number, cut.alias("at"))
    opened = rows.join(F.broadcast(weeks), "filed", "left_semi")
    return opened.join(wanted, "at", "left_semi").drop("filed", "at")


def _signature(frame: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)


def _status() -> Column:
    return (
        F.when(F.col("rows_new").isNull(), "missing in NEW")
        .when(F.col("rows_old").isNull(), "missing in OLD")
        .when(F.col("schema_match") & (F.col("rows_old") == F.col("rows_new")), "OK")
        .otherwise("DIFF")
    )


def compare_tables(old: Tables, new: Tables) -> DataFrame:
    """Per table: row counts of both versions, whether the schemas agree, and a status.

    The status is ``OK`` if rows and columns agree, ``DIFF`` if not, or says which
    version lacks the table.
    """
    parts = [("old", name, frame) for name, frame in old.items()]
    parts += [("new", name, frame) for name, frame in new.items()]
    counted = None
    for side, name, frame in parts:
        row = frame.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("file"),
            F.lit(side).alias("side"),
            F.lit(_signature(frame)).alias("columns"),
            "n",
        )
        counted = row if counted is None else counted.unionByName(row)

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    both = counted.groupBy("file").agg(
        of("old", "n").alias("rows_old"),
        of("new", "n").alias("rows_new"),
        F.coalesce(of("old", "columns") == of("new", "columns"), F.lit(False)).alias("schema_match"),
    )
    return both.select("file", _status().alias("status"), "rows_old", "rows_new", "schema_match")


def compare_weeks(old: Tables, new: Tables, content: bool = False) -> DataFrame:
    """Per ISO week and table: row counts of both versions, schema agreement, status.

    A row stands for one weekly file. Each table is counted once for all its weeks;
    rows without a time belong to no week and are left to :func:`compare_tables`.
    With ``content`` weeks of equal counts are ``OK`` only if their rows are the same,
    by a digest of them that needs no order.
    """
    counted = None
    for side, tables in (("old", old), ("new", new)):
        for name, frame in tables.items():
            timed = frame.where(F.col("datetime").isNotNull())
            weeks = timed.groupBy(iso_year("datetime").alias("iso_year"), iso_week("datetime").alias("iso_week"))
            digest = rows_digest(frame.columns) if content else F.lit(None).cast("decimal(38,0)")
            part = weeks.agg(F.count("*").alias("n"), digest.alias("digest")).select(
                "*", F.lit(name).alias("file"), F.lit(side).alias("side"), F.lit(_signature(frame)).alias("columns")
            )
            counted = part if counted is None else counted.unionByName(part)

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    both = counted.groupBy("iso_year", "iso_week", "file").agg(
        of("old", "n").alias("rows_old"),
        of("new", "n").alias("rows_new"),
        F.coalesce(of("old", "columns") == of("new", "columns"), F.lit(False)).alias("schema_match"),
        of("old", "digest").eqNullSafe(of("new", "digest")).alias("same"),
    )
    status = F.when((_status() == "OK") & ~F.col("same"), "DIFF").otherwise(_status())
    return both.select("iso_year", "iso_week", "file", status.alias("status"), "rows_old", "rows_new", "schema_match")


def _digests(frame: DataFrame, side: str, unit: list[Column], columns: list[str]) -> DataFrame:
    return frame.where(F.col("datetime").isNotNull()).groupBy(*unit).agg(F.count("*").alias("n"), rows_digest(columns).alias("digest")).withColumn("side", F.lit(side))


def _unequal(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of two versions whose counts or digests differ, with both counts."""
    both = old.unionByName(new).groupBy(*keys).agg(
        *[F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{c}_{side}") for c in ("n", "digest") for side in ("old", "new")]
    )
    differ = ~(F.col("n_old").eqNullSafe(F.col("n_new")) & F.col("digest_old").eqNullSafe(F.col("digest_new")))
    zero = F.lit(0).cast("long")
    return both.where(differ).select(*keys, F.coalesce("n_old", zero).alias("rows_old"), F.coalesce("n_new", zero).alias("rows_new"))


def differing_hours(old: DataFrame, new: DataFrame, weeks: list[tuple[int, int]] | None = None) -> DataFrame:
    """Hours in which two versions of a table hold different rows, and both counts.

    The versions are compared by week first and only rows of the weeks that differ are
    read again; ``weeks`` names these where they are known, as from the week statistics
    of stored tables. Their number is bounded by the calendar.
    """
    columns = [c for c in new.columns if c not in WEEK]
    unit = ["iso_year", "iso_week"]
    filed = set(unit) <= set(new.columns)
    own = [F.col(c) for c in unit] if filed else [iso_year("datetime").alias("iso_year"), iso_week("datetime").alias("iso_week")]
    if weeks is None:
        found = _unequal(_digests(old, "old", own, columns), _digests(new, "new", own, columns), unit)
        weeks = [(r.iso_year, r.iso_week) for r in found.collect()]
    number = own[0] * 100 + own[1]
    listed = [y * 100 + w for y, w in weeks]
    hour = F.date_trunc("HOUR", "datetime").cast("timestamp_ntz").alias("hour")
    parts = [_digests(frame.where(number.isin(listed)), side, [*own, hour], columns) for side, frame in (("old", old), ("new", new))]
    return _unequal(*parts, [*unit, "hour"])


def differing_weeks(old_statistics: DataFrame, new_statistics: DataFrame) -> DataFrame:
    """Tables and weeks whose stored rows differ between two versions, from their week
    statistics; neither version's rows are read."""
    keys = ["table_key", *WEEK]

    def of(statistics: DataFrame, side: str) -> DataFrame:
        whole = statistics.where(F.col("sensor_id").isNull())
        return whole.select(*keys, F.col("n_rows").alias("n"), "digest", F.lit(side).alias("side"))

    return _unequal(of(old_statistics, "old"), of(new_statistics, "new"), keys)


def matching(comparison: DataFrame) -> DataFrame:
    return comparison.where(F.col("status") == "OK")


def differing(comparison: DataFrame) -> DataFrame:
    return comparison.where(F.col("status") != "OK")


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns of both versions side by side in order, with the row counts."""
    ours, theirs = new.schema.fields, old.schema.fields
    rows = []
    for i in range(max(len(ours), len(theirs))):
        a = theirs[i] if i < len(theirs) else None
        b = ours[i] if i < len(ours) else None
        rows.append(
            (
                i + 1,
                a and a.name,
                a and a.dataType.simpleString(),
                b and b.name,
                b and b.dataType.simpleString(),
                bool(a and b and a.name == b.name and a.dataType == b.dataType),
            )
        )
    frame = new.sparkSession.createDataFrame(
        rows,
        "position int, old_name string, old_type string, new_name string, new_type string, "
        "matches boolean",
    )
    return frame.select(
        "*",
        old.agg(F.count("*")).scalar().alias("rows_old"),
        new.agg(F.count("*")).scalar().alias("rows_new"),
    )


# Which series the weekly report draws for each kind of sensor.
EXPECTED_SERIES = {"A": ["acceleration", "spectrum"], "S": ["strain"], "T": ["temperature"]}


def expected_series(sensors: DataFrame) -> DataFrame:
    """The sensors with each series the weekly report draws of them."""
    series = F.lit(None).cast("array<string>")
    for kind, names in EXPECTED_SERIES.items():
        series = F.when(F.col("kind") == kind, F.array(*[F.lit(n) for n in names])).otherwise(series)
    return sensors.select("sensor_id", "kind", "label", F.explode(series).alias("series"))


def _week_values(tables: Tables) -> DataFrame:
    """Per series, sensor and Monday of any row of its table: values, first and last time.

    Each table is read once; a wide one is reduced before its sensors become rows.
    """
    week = week_start("datetime").alias("monday")
    bounds = [F.min("datetime").alias("first_dt"), F.max("datetime").alias("last_dt")]
    accel = tables["accel_all"].select(
        "datetime", week, *[F.coalesce(*[f"{a}_{axis}" for axis in "xyz"]).alias(a) for a in ACCELEROMETERS]
    )
    wide = [(F.lit("acceleration"), accel, ACCELEROMETERS)]
    for hub in HUBS:
        names = sst_columns(hub)
        series = F.when(F.col("sensor_id").startswith("S"), "strain").otherwise("temperature")
        wide.append((series, tables[f"sst_{hub}"].select("datetime", week, *names), names))
    found = None
    for series, frame, names in wide:
        counts = frame.groupBy("monday").agg(*bounds, *[F.count(c).alias(c) for c in names])
        part = counts.unpivot(["monday", "first_dt", "last_dt"], names, "sensor_id", "n")
        part = part.select(series.alias("series"), "sensor_id", "monday", "n", "first_dt", "last_dt")
        found = part if found is None else found.unionByName(part)
    for hub in HUBS:
        spectra = tables[f"fft_{hub}"].groupBy("sensor_id", week).agg(*bounds, F.count("*").alias("n"))
        found = found.unionByName(spectra.withColumn("series", F.lit("spectrum")))
    return found.where(F.col("monday").isNotNull())


def missing_weeks(sensors: DataFrame, values: DataFrame) -> DataFrame:
    """Expected series without a value, per week from the earliest to the latest time.

    ``values`` has series, sensor_id, monday, n, first_dt and last_dt. The weeks of each
    series are gathered, and all of them to one row: the calendar and the list of
    sensors bound its size.
    """
    name = F.concat_ws("/", "series", "sensor_id").alias("name")
    seen = values.groupBy(name).agg(
        F.collect_set(F.when(F.col("n") > 0, F.col("monday"))).alias("mondays"), F.min("first_dt").alias("first_dt"), F.max("last_dt").alias("last_dt")
    )
    every = F.map_from_entries(F.collect_list(F.struct("name", "mondays")))
    one = seen.agg(F.struct(every.alias("seen"), weeks_between(F.min("first_dt"), F.max("last_dt")).alias("weeks")).alias("all"))
    met = expected_series(sensors).withColumn("all", one.scalar())
    own = F.element_at("all.seen", F.concat_ws("/", "series", "sensor_id"))
    known = F.coalesce(own, F.array().cast("array<date>"))
    left = met.select("series", "sensor_id", "label", F.explode(F.array_except("all.weeks", known)).alias("monday"))
    return left.select("*", week_label(iso_year("monday"), iso_week("monday")).alias("week"))


def coverage_missing(sensors: DataFrame, tables: Tables) -> DataFrame:
    """Series of the weekly report without a single value, per week and sensor.

    The weeks run from the earliest to the latest row of any table.
    """
    return missing_weeks(sensors, _week_values(tables))


def coverage_of_statistics(sensors: DataFrame, statistics: DataFrame) -> DataFrame:
    """As :func:`coverage_missing` for stored tables, from their week statistics alone.

    A week is the one a row is filed under.
    """
    monday = F.to_date(F.concat_ws("-", "iso_year", F.lit("01"), F.lit("04")))
    filed = F.date_add(F.trunc(monday, "week"), (F.col("iso_week") - 1) * 7)
    key, sensor = F.col("table_key"), F.col("sensor_id")
    series = (
        F.when(key == "accel_all", "acceleration").when(key.startswith("fft_"), "spectrum").when(sensor.startswith("S"), "strain").otherwise("temperature")
    )
    values = statistics.select(series.alias("series"), F.coalesce(sensor, F.lit("")).alias("sensor_id"), filed.alias("monday"), F.col("n_rows").alias("n"), "first_dt", "last_dt")
    return missing_weeks(sensors, values)
