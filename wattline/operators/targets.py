"""Consumption of bookings over the reporting window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.scalars import exact, exact_sum
from wattline.functions.timecols import day_starting
from wattline.operators.bookings import Period, days_of, on_extension
from wattline.operators.lookup import lookup_join

#: What names the device of a reading.
DEVICE = ["zone_device_id", "zone_device_control_id", "zone_device_code"]
DAY_HOURS = 24
TASKS_PER_CORE = 4


def hours_with_readings(hours: DataFrame, readings: DataFrame, max_bytes: int = 0) -> DataFrame:
    """Every booking hour with the hourly readings of its space, null where there are none.

    Readings measured below ``max_bytes`` are broadcast, so that the hours are not shuffled. With a
    ``max_bytes`` of zero the join merges sorted rows: the many hours of one key go over the same
    readings in turn, and readings are not broadcast because their files look small. Its rows are far
    more than what is shuffled for them, so the number of its tasks is given: adaptive execution goes
    by the shuffled bytes and would leave a few, some of them long after the others.
    """
    on = ["space_id", "date_time_key"]
    if not max_bytes:
        n = join_tasks(hours.sparkSession)
        hours, readings = hours.repartition(n, *on), readings.repartition(n, *on).hint("merge")
    return lookup_join(hours, readings, on, max_bytes=max_bytes)


def join_tasks(spark: SparkSession) -> int:
    """Tasks of a join that makes many rows of each: all shuffle partitions, and some for each core."""
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(given, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def hourly_sums(readings: DataFrame) -> DataFrame:
    """One row per space, hour and device type with the exact sum of ``accumulate_value``.

    :func:`day_sums` gives the same over these as over the readings, but an hour then meets a row per
    device type and not one per device.
    """
    return readings.groupBy("space_id", "date_time_key", "device_type").agg(
        F.sum(exact(F.col("accumulate_value"))).alias("accumulate_value")
    )


def day_sums(hours: DataFrame) -> DataFrame:
    """Sum of ``accumulate_value`` per business day, booking and device type."""
    return (
        hours.withColumn("actual_date_key", day_starting(F.col("date_time_key")))
        .groupBy("actual_date_key", "order_id", "on_rerent", "device_type")
        .agg(exact_sum(F.col("accumulate_value")).alias("accumulate_value"))
    )


def space_days(readings: DataFrame) -> DataFrame:
    """Per space and business day: the hours read as bits, and per device type the sum of
    ``accumulate_value`` and the ids of the least device, as an array ``read``."""
    named = F.coalesce(*(F.col(c).cast("string") for c in DEVICE)).isNotNull()
    hour = F.call_function("shiftleft", F.lit(1), F.hour("date_time_key"))
    sums = readings.groupBy(
        "space_id", day_starting(F.col("date_time_key")).alias("date"), "device_type"
    ).agg(
        F.sum(exact(F.col("accumulate_value"))).alias("accumulate_value"),
        F.min(F.when(named, F.struct(*DEVICE))).alias("device"),
        F.bit_or(hour).alias("hours"),
    )
    read = F.collect_list(F.struct("device_type", "accumulate_value", "device"))
    return sums.groupBy("space_id", "date").agg(read.alias("read"), F.bit_or("hours").alias("hours"))


def booking_day_sums(days: DataFrame, readings: DataFrame) -> DataFrame:
    """:func:`day_sums` of the hours of ``days``, without making the hours. Hours without readings
    are a row per day with a null device type and amount.

    A booking day runs from 13:00 to 12:00, which is exactly the business day of that date, so the
    readings can be summed per space and day first: some 24 times fewer rows meet in the one join.
    """
    met = lookup_join(days, space_days(readings), ["space_id", "date"], max_bytes=0)
    kind = met.schema["read"].dataType
    gap = F.array(F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in kind.elementType)))
    missing = F.bit_count(F.coalesce("hours", F.lit(0))) < DAY_HOURS
    none = F.slice(gap, 1, 0)
    rows = F.concat(F.coalesce("read", none), F.when(missing, gap).otherwise(none))
    return met.select(*days.columns, F.inline(rows)).withColumnRenamed("date", "actual_date_key")


def period_sums(day_values: DataFrame) -> DataFrame:
    """Sum and number of days per booking and device type outside extension days."""
    return (
        day_values.filter(~F.col("on_rerent"))
        .groupBy("order_id", "device_type")
        .agg(
            exact_sum(F.col("accumulate_value")).alias("consumption"),
            F.count(F.lit(1)).alias("days"),
        )
    )


def consumption_target(
    windows: DataFrame, readings: DataFrame, period: Period, created_at: Column
) -> DataFrame:
    """Per booking, space and device type the consumption outside extension days, and the ids of the
    least device that was read. Hours without readings count under a null device type.

    ``on_rerent`` tells whether the booking is on extension on the last date of the window.
    """
    who = ["order_id", "order_number", "user_name", "room", "space_id", "on_rerent_now"]
    days = days_of(windows.withColumn("on_rerent_now", on_extension(period.last, period)), period)
    open_days = days.filter(~F.col("on_rerent")).select(*who, "date")
    return (
        booking_day_sums(open_days, readings)
        .groupBy(*who, "device_type")
        .agg(
            F.min("device").alias("device"),
            exact_sum(F.col("accumulate_value")).alias("consumption"),
            F.count_distinct("actual_date_key").alias("days"),
        )
        .select(*who, "device_type", *(f"device.{c}" for c in DEVICE), "consumption", "days")
        .withColumnRenamed("on_rerent_now", "on_rerent")
        .withColumns({"date_key": period.last, "created_at": created_at})
    )
