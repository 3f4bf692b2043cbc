"""The end-to-end jobs. Each takes DataFrames and returns the DataFrame to be written."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.timecols import cut_of, day_range
from wattline.operators import bookings as bk
from wattline.operators import enrich, gapfill, history, reduce, targets, totals
from wattline.operators.lookup import lookup_join
from wattline.schemas import LAST_KNOWN, READING, TRIPLE
from wattline.sources.readers import since, stored_or_empty, time_range
from wattline.sources.writers import merge_partitions, replace_partitions, upsert


def ingest(
    readings: DataFrame, registry: DataFrame, invalid: DataFrame, master: DataFrame
) -> DataFrame:
    """Live readings, each with its route and typed value."""
    return enrich.typed_values(enrich.classify(enrich.live(readings), registry, invalid, master))


def hourly_meter(readings: DataFrame) -> DataFrame:
    return reduce.hourly_max(readings)


def registered_only(readings: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Readings of registered devices when a registry is given, else all readings."""
    if registry is None:
        return readings
    return lookup_join(readings, registry.select(*TRIPLE).distinct(), TRIPLE, "left_semi")


def hourly_filled(
    readings: DataFrame,
    start: Any | None = None,
    registry: DataFrame | None = None,
    last_known: DataFrame | None = None,
    unique_times: bool = False,
    date_column: str | None = None,
) -> DataFrame:
    """History readings since ``start`` with missing hours filled by the smaller neighbour."""
    picked = registered_only(since(readings, "ts", start, date_column) if start else readings, registry)
    whole = picked.select(*READING).withColumn("ts", F.date_trunc("second", "ts"))
    if last_known is None:
        filled = gapfill.fill_between(whole, "ts", unique_times)
    else:
        filled, _ = gapfill.fill_incremental(whole, last_known, "ts", unique_times)
    return filled.withColumnRenamed("ts", "date_time_key")


def last_known(spark: SparkSession, state: str, load: int) -> DataFrame:
    """The last-known readings that the newest load before ``load`` left; none before the first."""
    earlier = stored_or_empty(spark, state, LAST_KNOWN).filter(F.col("load") < load)
    newest = earlier.agg(F.max("load").alias("load")).first()["load"]
    return earlier.filter(F.col("load") == F.lit(newest).cast("int")).drop("load")


def load_hours(
    spark: SparkSession, readings: DataFrame, load: int, table: str, state: str, unique_times: bool = False
) -> None:
    """One load of the incremental fill, into ``table``, which holds one row per device and time.

    Readings of one device and second replace each other: that of the newest load stays, then that of
    the greatest value. What the load leaves as last known goes to ``state``, numbered, so a load that
    is run again starts from the same readings and replaces what it wrote.
    """
    whole = readings.select(*READING).withColumn("ts", F.date_trunc("second", "ts"))
    rows, latest = gapfill.fill_incremental(whole, last_known(spark, state, load), "ts", unique_times)
    dated = rows.withColumnRenamed("ts", "date_time_key").withColumns(
        {"load": F.lit(load), "date_key": F.to_date("date_time_key")}
    )
    upsert(spark, dated, table, [*TRIPLE, "date_time_key"], "load")
    replace_partitions(latest.withColumn("load", F.lit(load)), state, ["load"])


def missing_dates(
    readings: DataFrame,
    start: Any | None = None,
    registry: DataFrame | None = None,
    unique_times: bool = False,
    date_column: str | None = None,
) -> DataFrame:
    """History readings since ``start`` with missing whole hours filled by the reading before."""
    picked = registered_only(since(readings, "ts", start, date_column) if start else readings, registry)
    whole = picked.select(*READING).withColumn("ts", F.date_trunc("second", "ts"))
    return gapfill.fill_forward(whole, "ts", unique_times=unique_times).withColumnRenamed(
        "ts", "date_time_key"
    )


def day_readings(
    hourly: DataFrame, as_of: Any, days: int = 1, date_column: str | None = None
) -> DataFrame:
    """Hourly readings of the ``days`` business days that end on ``as_of``, as one scan range."""
    end = F.lit(as_of).cast("timestamp")
    bounds = cut_of(end, 12, -days), day_range(end)[1]
    return time_range(hourly, "date_time_key", *bounds, date_column)


def with_device(daily: DataFrame, master: DataFrame) -> DataFrame:
    """Daily rows of meters in the master table, with their device code."""
    meters = master.filter(
        enrich.is_meter(F.col("device_type_c"), F.col("zone_device_control_tag"))
        & F.col("zone_device_code").isNotNull()
    ).select(*TRIPLE, F.col("zone_device_code").alias("device"))
    return lookup_join(daily, meters, TRIPLE, "inner")


def with_room(daily: DataFrame, spaces: DataFrame) -> DataFrame:
    """Daily rows with their room code, null outside rooms."""
    return lookup_join(daily, bk.rooms_only(spaces).select("space_id", "room"), ["space_id"])


def daily_consumption(
    hourly: DataFrame,
    master: DataFrame,
    spaces: DataFrame,
    created_at: Column,
    as_of: Any | None = None,
    days: int = 1,
    unique_times: bool = True,
    date_column: str | None = None,
) -> DataFrame:
    """Consumption and meter total per device and business day, with device and room codes.

    The whole range of days is one query. Without ``as_of`` it is every day in the table.
    ``date_column`` names the calendar date the hourly table is partitioned by, if it is.
    """
    picked = hourly if as_of is None else day_readings(hourly, as_of, days, date_column)
    daily = reduce.daily_consumption(picked, unique_times=unique_times)
    return with_room(with_device(daily, master), spaces).select(
        "consumption",
        F.col("value").alias("amount"),
        "room",
        "device",
        "date_key",
        created_at.alias("created_at"),
    )


def booking_hours(
    bookings: DataFrame,
    history: DataFrame,
    extensions: DataFrame,
    users: DataFrame,
    spaces: DataFrame,
    as_of: str,
    order_id: int | None = None,
    repeat_start: bool = False,
    newest_first: bool = False,
) -> DataFrame:
    """Every hour of the reporting window for every booking that counts."""
    period = bk.Period(as_of)
    windows = bk.booked_windows(
        bookings, history, extensions, users, spaces, period, order_id, repeat_start
    )
    hours = bk.booking_hours(bk.days_of(bk.spread(windows), period))
    return hours.orderBy(F.desc("date_time_key"), "order_id") if newest_first else hours


def consumption_target(
    bookings: DataFrame,
    history: DataFrame,
    extensions: DataFrame,
    users: DataFrame,
    spaces: DataFrame,
    readings: DataFrame,
    as_of: str,
    created_at: Column,
    order_id: int | None = None,
    repeat_start: bool = False,
    date_column: str | None = None,
) -> DataFrame:
    """Consumption per booking and device type over the window, without its extension days.

    ``date_column`` names the calendar date the readings are partitioned by, if they are.
    """
    period = bk.Period(as_of)
    windows = bk.booked_windows(
        bookings, history, extensions, users, spaces, period, order_id, repeat_start
    )
    in_window = window_readings(readings, period, date_column)
    return targets.consumption_target(windows, in_window, period, created_at)


def window_readings(readings: DataFrame, period: bk.Period, date_column: str | None = None) -> DataFrame:
    """The readings of the business days of a reporting window, as one scan range."""
    midnight = F.lit(period.as_of).cast("timestamp")
    bounds = cut_of(midnight, 12, -period.days - 1), cut_of(midnight, 13)
    return time_range(readings, "date_time_key", *bounds, date_column)


def consumption_from_totals(
    bookings: DataFrame,
    history: DataFrame,
    extensions: DataFrame,
    users: DataFrame,
    spaces: DataFrame,
    readings: DataFrame,
    as_of: str,
    order_id: int | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """Consumption and days per booking and device type, by differences of running totals."""
    period = bk.Period(as_of)
    windows = bk.booked_windows(bookings, history, extensions, users, spaces, period, order_id)
    return totals.period_sums_from_totals(windows, window_readings(readings, period, date_column), period)


def history_backfill(responses: DataFrame, column: str = "value") -> DataFrame:
    return history.history_reads(responses, column)


def wide_day_export(wide: DataFrame, device_type: str, day: Any) -> DataFrame:
    return history.wide_export(wide, device_type, F.lit(day).cast("date"))


def load_daily(
    spark: SparkSession, readings: DataFrame, path: str, time: str = "date_time_key", unique_times: bool = True
) -> None:
    """One load of hourly readings into the stored first and last records per device and business day.

    Loads may come in any order and more than once; only the days that a load touches are read and
    replaced.
    """
    merge_partitions(spark, reduce.daily_ends(readings, time, unique_times=unique_times), path, reduce.merged_ends)
