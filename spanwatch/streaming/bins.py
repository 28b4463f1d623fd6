"""Binned means and minute resultants of a stream.

Each row closes once the watermark has passed its bin. Rows later than the
watermark are dropped; ``LateRows`` counts them, and ``streaming/late.py`` keeps them.
Medians are left to the batch form: their state would grow with the bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from spanwatch.functions import resultant_sql
from spanwatch.model import ACCELEROMETERS
from spanwatch.operators.series import check_accelerometers, spread_sql


def _binned(stream: DataFrame, minutes: int, delay: str):
    # Streaming state keeps event time in the zoned type. The zone-free time is read
    # as one of UTC, where no hour is missing or double and bins begin on the hour;
    # the session's zone plays no part.
    utc = F.make_timestamp_ltz(
        F.year("datetime"), F.month("datetime"), F.dayofmonth("datetime"), F.hour("datetime"), F.minute("datetime"),
        F.extract(F.lit("SECOND"), F.col("datetime")), F.lit("UTC"),
    )
    timed = stream.withColumn("datetime", utc)
    return timed.withWatermark("datetime", delay).groupBy(F.window("datetime", f"{minutes} minutes"))


def _zone_free(instant: Column) -> Column:
    """The UTC clock of an instant."""
    micros = F.make_dt_interval(secs=(F.unix_micros(instant) / 1_000_000).cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + micros


def stream_means(
    stream: DataFrame, columns: list[str], minutes: int = 15, delay: str = "1 hour"
) -> DataFrame:
    """Mean of each column per bin."""
    means = _binned(stream, minutes, delay).agg(*[F.avg(c).alias(c) for c in columns])
    return means.select(
        _zone_free(F.col("window.start")).alias("bin_start"),
        F.lit(minutes).alias("bin_minutes"),
        *columns,
    )


def stream_accel_minute(
    stream: DataFrame, sensors: list[str] = ACCELEROMETERS, delay: str = "1 hour"
) -> DataFrame:
    """Mean, least and greatest resultant per sensor and minute."""
    check_accelerometers(stream, sensors)
    lengths = stream.select("datetime", *[F.expr(resultant_sql(s)).alias(s) for s in sensors])
    reduced = _binned(lengths, 1, delay).agg(*[F.expr(spread_sql(s)).alias(s) for s in sensors])
    minute = _zone_free(F.col("window.start")).alias("minute")
    rows = reduced.select(minute, *sensors).unpivot(["minute"], sensors, "sensor_id", "v")
    return rows.select("sensor_id", "minute", "v.v_avg", "v.v_min", "v.v_max")


class LateRows(StreamingQueryListener):
    """Counts the rows each query dropped for coming after the watermark.

    Add it to ``spark.streams`` before a query starts; ``dropped`` holds the counts by
    query id. A query itself only remembers its most recent steps.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        name = str(event.progress.id)
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self.dropped[name] = self.dropped.get(name, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
