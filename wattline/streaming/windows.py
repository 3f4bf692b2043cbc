"""Event-time minute and hour windows over message streams.

Each takes a streaming DataFrame with a timestamp ``ts`` and returns a streaming DataFrame for
append mode. The aggregates combine on the map side before the state shuffle, so one busy device
or space costs one row per task and window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.reduce import flagged_time, flags_of
from wattline.schemas import CAMERA_MESSAGE, FLAGS, METER_MESSAGE, TRIPLE

LATENESS = "10 minutes"


def meter_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Typed meter or CO2 readings of a message stream."""
    return _typed(raw, value, METER_MESSAGE)


def camera_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    return _typed(raw, value, CAMERA_MESSAGE)


def _typed(raw: DataFrame, value: str, schema: str) -> DataFrame:
    parsed = raw.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), schema))))
    return parsed.withColumn("ts", F.col("ts").try_cast("timestamp")).filter("ts is not null")


def hourly_meter(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Per device and hour the record with the greatest value, once the hour is closed."""
    best = F.max(F.struct("value", "ts", *FLAGS)).alias("best")
    return (
        readings.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 hour"), *TRIPLE)
        .agg(best)
        .select(
            *TRIPLE,
            *(f"best.{c}" for c in FLAGS),
            "best.value",
            F.col("window.start").alias("date_time_key"),
            F.window_time("window").alias("closed_at"),
        )
    )


def minute_camera(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Per space and minute the sum of counts, with the flags of the last record."""
    return (
        readings.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 minute"), "space_id")
        .agg(F.sum("value").cast("int").alias("value"), F.max(flagged_time("ts")).alias("last"))
        .select("space_id", "value", *flags_of(F.col("last")), F.col("window.start").alias("ts"))
    )


def minute_co2(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Per device and minute the first record of the minute."""
    first = F.min(F.struct("ts", "value", *FLAGS)).alias("first")
    return (
        readings.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 minute"), *TRIPLE)
        .agg(first)
        .select(
            *TRIPLE,
            "first.value",
            *(f"first.{c}" for c in FLAGS),
            F.col("window.start").alias("ts"),
            F.window_time("window").alias("closed_at"),
        )
    )
