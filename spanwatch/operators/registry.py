"""The sensor list as a DataFrame, and lookups in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.model import GAUGES, HUB_SENSORS, HUBS, LOCATIONS, thermometer_of

SCHEMA = "sensor_id string, kind string, hub string, temp_sensor_id string, label string"


def registry(spark: SparkSession) -> DataFrame:
    """One row per installed sensor."""
    rows = [
        (s, kind, hub, thermometer_of(s) if kind == "S" else None, LOCATIONS[s])
        for hub in HUBS
        for kind, sensors in HUB_SENSORS[hub].items()
        for s in sensors
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_sensor(frame: DataFrame, sensors: DataFrame, columns: list[str]) -> DataFrame:
    """Look up registry ``columns`` by ``sensor_id``; an unknown sensor keeps its id as label.

    The registry is a list of installed devices held in code, so it is broadcast.
    """
    looked_up = frame.join(F.broadcast(sensors.select("sensor_id", *columns)), "sensor_id", "left")
    if "label" in columns:
        looked_up = looked_up.withColumn("label", F.coalesce("label", "sensor_id"))
    return looked_up


def gauge_series(spark: SparkSession, gauges: list[str] = GAUGES) -> DataFrame:
    """For each gauge the two series of its chart: its own and its thermometer's."""
    unknown = [g for g in gauges if g not in GAUGES]
    if unknown:
        raise ValueError(f"not strain gauges: {unknown}")
    rows = [(g, g, "strain") for g in gauges] + [(thermometer_of(g), g, "temp") for g in gauges]
    return spark.createDataFrame(rows, "series string, sensor_id string, role string")
