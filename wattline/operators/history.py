"""Readings from landed history responses, and the wide day export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.scalars import as_double
from wattline.functions.timecols import MILLIS, format_time
from wattline.schemas import HISTORY_RESPONSE, READING, SNAKE_NAMES, TRIPLE, WIDE_EXPORT


def history_reads(responses: DataFrame, column: str = "value") -> DataFrame:
    """One row per read of each response; texts without ``data`` or that are not JSON give none."""
    return (
        responses.select(F.explode(F.from_json(column, HISTORY_RESPONSE)["data"]["reads"]).alias("read"))
        .select("read.*")
        .withColumnsRenamed(SNAKE_NAMES)
        .withColumn("value", as_double(F.col("value")))
        .select(*READING)
    )


def wide_export(wide: DataFrame, device_type: str, day: Column, ordered: bool = True) -> DataFrame:
    """All 34 columns of one device type and day, times as text, ordered by device.

    Time and id follow the device in the order, so that the sort can split a device with very many
    rows over several tasks. ``date_key`` is the date of year, month and day; tables partitioned by it
    are pruned.
    """
    picked = wide.filter(
        (F.col("device_type") == device_type)
        & (F.col("date_key").cast("date") == day)
        & (F.col("year") == F.year(day))
        & (F.col("month") == F.month(day))
        & (F.col("day") == F.dayofmonth(day))
    )
    times = {c: format_time(F.col(c), MILLIS) for c in ["event_datetime", "date_time_key", "created_at"]}
    shaped = picked.withColumns({**times, "date_key": format_time(F.col("date_key"), "yyyy-MM-dd")})
    shaped = shaped.select(*WIDE_EXPORT)
    return shaped.orderBy(*TRIPLE, "event_datetime", "device_id") if ordered else shaped
