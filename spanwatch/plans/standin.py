"""The nine weekly tables, and raw documents, derived from the given tables.

The given tables hold no sensor data, so every row of ``events`` stands for one
sensor document and every row of ``embeddings`` for one spectrum. All rows are
used. ``plans/oracle.py`` states the same derivation in SQL.

  event:     value and k (from props) give every gauge, thermometer and axis
             gauge Si = value * i + k             missing when event_type = error
             thermometer Tj = k / 2 - j           missing for even j when purchase
             accelerometer Aa: t = k, x = value / (100 + a), y = k / 50,
                               z = (a - 29) / 4   A32 absent when click
             hub3 sends nothing when event_type = view
  embedding: sensor by label, amplitudes = the vector, frequencies half a hertz
             apart, one spectrum an hour
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.model import (
    ACCELEROMETERS,
    GAUGES,
    HUB_SENSORS,
    HUBS,
    TABLE_KEYS,
    accel_columns,
    sst_columns,
)
from spanwatch.sources.statistics import update_statistics
from spanwatch.sources.store import merge_weeks, table_path, with_week

ABSENT_HUB = {"hub3": "view"}
ABSENT_ACCELEROMETER = {"A32": "click"}


@lru_cache(maxsize=64)
def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=64)
def _spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table dealt evenly over the shuffle partitions of the session.

    Building and parsing documents is costly per row, and a table may come as one
    file, which a single task would read.
    """
    return read(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return (_spread if spread else read)(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts AS datetime",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') AS int) AS k",
    )


def reading(sensor: str) -> str:
    """Value of a gauge or thermometer, in double."""
    number = int(sensor[1:])
    if sensor in GAUGES:
        return f"CASE WHEN event_type <> 'error' THEN value * {number} + k END"
    value = f"k / 2D - {number}"
    return value if number % 2 else f"CASE WHEN event_type <> 'purchase' THEN {value} END"


def axis(sensor: str, name: str) -> str:
    """Value of one accelerometer axis, in double."""
    number = int(sensor[1:])
    value = {
        "t": "cast(k AS double)",
        "x": f"value / {100 + number}",
        "y": "k / 50D",
        "z": f"{(number - 29) / 4}D",
    }[name]
    absent = ABSENT_ACCELEROMETER.get(sensor)
    return value if absent is None else f"CASE WHEN event_type <> '{absent}' THEN {value} END"


def sst(spark: SparkSession, sf_dir: str, hub: str) -> DataFrame:
    return sst_of(events(spark, sf_dir), hub)


def sst_of(frame: DataFrame, hub: str) -> DataFrame:
    """Rows of one hub's table for the given events."""
    if hub in ABSENT_HUB:
        frame = frame.where(F.col("event_type") != ABSENT_HUB[hub])
    return frame.selectExpr(
        "datetime", *[f"cast({reading(c)} AS float) AS {c}" for c in sst_columns(hub)]
    )


def accel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accel_of(events(spark, sf_dir))


def accel_of(frame: DataFrame) -> DataFrame:
    """Rows of the acceleration table for the given events."""
    return frame.selectExpr(
        "datetime", *[f"cast({axis(*c.split('_'))} AS float) AS {c}" for c in accel_columns()]
    )


def _spectra(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    names = ", ".join(f"'{a}'" for a in ACCELEROMETERS)
    return (_spread if spread else read)(spark, sf_dir, "embeddings").selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(vec_id AS int)) AS datetime",
        f"get(array({names}), pmod(label, {len(ACCELEROMETERS)})) AS sensor_id",
        "label + 0.5D AS main_f",
        "get(embedding, 0) AS main_a",
        "transform(embedding, (x, i) -> i * 0.5D) AS freqs",
        "embedding AS amps",
    )


def fft(spark: SparkSession, sf_dir: str, hub: str) -> DataFrame:
    frame = _spectra(spark, sf_dir).where(F.col("sensor_id").isin(HUB_SENSORS[hub]["A"]))
    return frame.selectExpr(
        "datetime",
        "sensor_id",
        "cast(main_f AS float) AS fft_main_f",
        "cast(main_a AS float) AS fft_main_a",
        "cast(freqs AS array<float>) AS fft_freqs",
        "cast(amps AS array<float>) AS fft_amps",
    )


def table(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    if key == "accel_all":
        return accel(spark, sf_dir)
    family, hub = key.split("_")
    return fft(spark, sf_dir, hub) if family == "fft" else sst(spark, sf_dir, hub)


def tables(spark: SparkSession, sf_dir: str, keys: list[str] = TABLE_KEYS) -> dict[str, DataFrame]:
    return {key: table(spark, sf_dir, key) for key in keys}


def store(spark: SparkSession, sf_dir: str, base: str, keys: list[str] = TABLE_KEYS) -> None:
    """The tables written as weekly tables below ``base``, with their week statistics.

    They are written side by side: a table of few weeks has few tasks at a time."""

    def write(key: str) -> None:
        merge_weeks(with_week(table(spark, sf_dir, key)), table_path(base, key))

    with ThreadPoolExecutor(len(keys)) as pool:
        list(pool.map(write, keys))
    update_statistics(spark, base, keys=keys)


def iso_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _unless(event_type: str | None, body: str) -> str:
    if event_type is None:
        return body
    return f"CASE WHEN event_type <> '{event_type}' THEN {body} END"


def reading_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per event, with all gauges, thermometers and accelerometers."""
    fields = []
    for a in ACCELEROMETERS:
        body = ", ".join(f"'{n}', {axis(a, n)}" for n in "txyz")
        fields.append(f"'{a}', {_unless(ABSENT_ACCELEROMETER.get(a), f'named_struct({body})')}")
    for hub in HUBS:
        for s in sst_columns(hub):
            key = "s" if s in GAUGES else "t"
            body = f"named_struct('{key}', {reading(s)})"
            fields.append(f"'{s}', {_unless(ABSENT_HUB.get(hub), body)}")
    stamped = events(spark, sf_dir, spread=True).withColumn("stamp", iso_text(F.col("datetime")))
    return stamped.selectExpr(
        f"to_json(named_struct('time', named_struct('datetime', stamp), {', '.join(fields)})) AS value"
    )


def spectrum_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per embedding, with one accelerometer's spectrum."""
    points = F.transform(
        F.arrays_zip("freqs", "amps"),
        lambda p: F.struct(p["freqs"].alias("f"), p["amps"].alias("a")),
    )
    body = F.struct(
        F.struct(
            F.struct(F.col("main_f").alias("f"), F.col("main_a").alias("a")).alias("main"),
            points.alias("spectrum"),
        ).alias("fft")
    )
    return _spectra(spark, sf_dir, spread=True).select(
        F.to_json(
            F.struct(
                F.struct(iso_text(F.col("datetime")).alias("datetime")).alias("time"),
                *[F.when(F.col("sensor_id") == a, body).alias(a) for a in ACCELEROMETERS],
            )
        ).alias("value")
    )


def plain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One short JSON line per event, spelled out so that its text is known."""
    line = F.concat(
        F.lit('{"time":{"datetime":"'),
        iso_text(F.col("datetime")),
        F.lit('"},"S7":{"s":'),
        F.col("event_id").cast("string"),
        F.lit("}}"),
    )
    return events(spark, sf_dir).select(line.alias("value"))


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``plain_lines`` with a fault by event type: a cut line, an unreadable time,
    an empty time, no time."""
    number = F.col("event_id").cast("string")
    good = F.concat(
        F.lit('{"time":{"datetime":"'), iso_text(F.col("datetime")), F.lit('"},"S7":{"s":'), number
    )
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", good)
        .when(kind == "click", F.concat(F.lit('{"time":{"datetime":"event '), number, F.lit('"}}')))
        .when(kind == "signup", F.lit('{"time":{"datetime":""}}'))
        .when(kind == "view", F.concat(F.lit('{"S7":{"s":'), number, F.lit("}}")))
        .otherwise(F.concat(good, F.lit("}}")))
    )
    return events(spark, sf_dir).select(line.alias("value"))


def versions(spark: SparkSession, sf_dir: str, hub: str = "hub2") -> tuple[DataFrame, DataFrame]:
    """An old and a new version of one hub's table, which each lack one kind of event."""
    columns = [f"cast({reading(c)} AS float) AS {c}" for c in sst_columns(hub)]
    rows = events(spark, sf_dir)
    old = rows.where(F.col("event_type") != "signup").selectExpr("datetime", *columns)
    new = rows.where(F.col("event_type") != "view").selectExpr("datetime", *columns)
    return old, new
