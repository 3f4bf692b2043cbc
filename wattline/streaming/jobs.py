"""The three reducing streams from raw messages to a table partitioned by date."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.streaming import carry, windows
from wattline.streaming.run import start_append


def hourly_meter(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str = windows.LATENESS,
    max_hours: int | None = None,
    initial: DataFrame | None = None,
    **sink: Any,
) -> StreamingQuery:
    """Hourly meter readings; a silent meter repeats its last reading every hour. ``initial`` hands the
    state of an earlier stream over (``carry.last_states`` of its table)."""
    carry.use_rocksdb(messages.sparkSession)
    hours = windows.hourly_meter(windows.meter_messages(messages), lateness)
    rows = carry.carry_forward(hours, "date_time_key", 3600, max_hours, initial)
    return _start(rows, "date_time_key", path, checkpoint, sink)


def minute_co2(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str = windows.LATENESS,
    max_minutes: int | None = None,
    initial: DataFrame | None = None,
    as_runs: bool = False,
    **sink: Any,
) -> StreamingQuery:
    """The first CO2 reading of every minute; a silent sensor repeats its last one.

    A sensor is silent most minutes. With ``as_runs`` repeats are stored as runs (``ts`` to ``until``),
    some thousand times fewer rows, and ``carry.every_period`` gives the minutes when they are read.
    """
    carry.use_rocksdb(messages.sparkSession)
    minutes = windows.minute_co2(windows.meter_messages(messages), lateness)
    rows = carry.carry_runs(minutes, "ts", 60, max_minutes, initial)
    if not as_runs:
        rows = carry.every_period(rows, "ts", 60)
    return _start(rows, "ts", path, checkpoint, sink)


def minute_camera(
    messages: DataFrame, path: str, checkpoint: str, lateness: str = windows.LATENESS, **sink: Any
) -> StreamingQuery:
    """The sum of camera counts per space and minute."""
    minutes = windows.minute_camera(windows.camera_messages(messages), lateness)
    return _start(minutes, "ts", path, checkpoint, sink)


def _start(
    stream: DataFrame, time: str, path: str, checkpoint: str, sink: dict[str, Any]
) -> StreamingQuery:
    dated = stream.withColumn("date_key", F.to_date(time))
    return start_append(dated, path, checkpoint, partition_by=["date_key"], **sink)
