"""Consumption of bookings from running totals.

Readings are summed once per space, device type and business day. The totals of the days before each
day of the reporting window stand in one array per space and type, so what a booking used between two
days is the difference of two entries. A booking's days outside its extensions are a few intervals; its
consumption is the sum of total(end) - total(start) over them. No day or hour of a booking is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.scalars import exact
from wattline.functions.timecols import day_starting
from wattline.operators.bookings import Period, bits_per_word, on_extension
from wattline.operators.lookup import lookup_join, settle

_AMOUNT = "decimal(38,9)"
DAY_HOURS = 24


def space_type_days(readings: DataFrame, period: Period) -> DataFrame:
    """Per space, device type and date of the window (``position``): the amount, how many readings had
    one, and the hours read as bits. Rows collapse on the map side, so a busy space is a row per task,
    type and day."""
    position = F.datediff(day_starting(F.col("date_time_key")), period.first)
    hour = F.call_function("shiftleft", F.lit(1), F.hour("date_time_key"))
    return (
        readings.withColumn("position", position)
        .filter(F.col("position").between(0, period.days))
        .groupBy("space_id", "device_type", "position")
        .agg(
            F.coalesce(F.sum(exact(F.col("accumulate_value"))), F.lit(0)).cast(_AMOUNT).alias("amount"),
            F.count("accumulate_value").alias("amounts"),
            F.bit_or(hour).alias("hours"),
        )
    )


def _day_bits(position: Column, word: int, width: int) -> Column:
    """The bit of a date in a bitmap word, 0 for dates of other words."""
    at = position - word * width
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
    return F.when(at.between(0, width - 1), bit).otherwise(F.lit(0).cast("bigint"))


def running_totals(days: DataFrame, period: Period) -> DataFrame:
    """One row per space and device type of :func:`space_type_days`.

    ``totals`` and ``counts`` hold the amount and the number of amounts before each date of the window,
    and one entry more for its end; ``read_w`` are the dates with readings as bitmap words.
    """
    by_day = F.map_from_entries(F.collect_list(F.struct("position", F.struct("amount", "amounts"))))
    words = {f"read_{w}": F.bit_or(_day_bits(F.col("position"), w, bits_per_word())) for w in period.words}
    rows = days.groupBy("space_id", "device_type").agg(
        by_day.alias("by_day"), *(bits.alias(name) for name, bits in words.items())
    )

    def before(field: str, kind: str) -> Column:
        zero = F.lit(0).cast(kind)
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(period.days)),
            F.array(zero),
            lambda sums, p: F.concat(
                sums, F.array((F.element_at(sums, -1) + F.coalesce(F.col("by_day")[p][field], zero)).cast(kind))
            ),
        )

    return rows.select(
        "space_id", "device_type", before("amount", _AMOUNT).alias("totals"),
        before("amounts", "bigint").alias("counts"), *words,
    )


def full_days(days: DataFrame, period: Period) -> DataFrame:
    """Per space the dates of which every hour was read, by whatever device type, as ``full_w``."""
    read = days.groupBy("space_id", "position").agg(F.bit_or("hours").alias("hours"))
    whole = F.bit_count("hours") == DAY_HOURS
    return read.groupBy("space_id").agg(
        *(
            F.bit_or(F.when(whole, _day_bits(F.col("position"), w, bits_per_word())).otherwise(F.lit(0).cast("bigint"))).alias(f"full_{w}")
            for w in period.words
        )
    )


def kept_intervals(period: Period) -> Column:
    """Ends of a booking's runs of dates outside its extensions: an array of (at, sign), where the total
    before date ``at`` counts negative at the start of a run and positive after its end."""

    def kept(p: Column) -> Column:
        inside = p.between(0, period.days)
        return inside & ~on_extension(F.date_add(period.first, F.greatest(p, F.lit(0))), period)

    ends = F.filter(F.sequence(F.lit(0), F.lit(period.days + 1)), lambda p: kept(p) != kept(p - 1))
    return F.transform(ends, lambda p: F.struct(p.alias("at"), F.when(kept(p), -1).otherwise(1).alias("sign")))


def _over_intervals(totals: str, kind: str) -> Column:
    return F.aggregate(
        "kept", F.lit(0).cast(kind), lambda sum_, e: (sum_ + e["sign"] * F.col(totals)[e["at"]]).cast(kind)
    )


def period_sums_from_totals(windows: DataFrame, readings: DataFrame, period: Period) -> DataFrame:
    """Per booking and device type the consumption outside extension days and the number of days with
    readings; days of which an hour has no reading count under a null device type.

    ``windows`` are booked windows (a row per booking and space with its extension bitmap). Equals
    ``targets.period_sums`` of the day sums of every hour of every booking.
    """
    days = settle(space_type_days(readings, period))
    totals = settle(running_totals(days, period))
    width = bits_per_word()
    mask = {w: (1 << min(width, period.days + 1 - w * width)) - 1 for w in period.words}
    free = {w: F.bitwise_not(F.coalesce(F.col(f"days_{w}"), F.lit(0).cast("bigint"))) for w in period.words}
    booked = windows.select(
        "order_id", "space_id", kept_intervals(period).alias("kept"),
        *(free[w].bitwiseAND(F.lit(mask[w])).alias(f"free_{w}") for w in period.words),
    )
    used = lookup_join(booked, totals, ["space_id"], "inner").select(
        "order_id", "device_type", _over_intervals("totals", _AMOUNT).alias("amount"),
        _over_intervals("counts", "bigint").alias("amounts"),
        *(F.col(f"free_{w}").bitwiseAND(F.col(f"read_{w}")).alias(f"on_{w}") for w in period.words),
    )
    gaps = lookup_join(booked, settle(full_days(days, period)), ["space_id"]).select(
        "order_id", F.lit(None).cast(totals.schema["device_type"].dataType).alias("device_type"),
        F.lit(0).cast(_AMOUNT).alias("amount"), F.lit(0).cast("bigint").alias("amounts"),
        *(
            F.col(f"free_{w}").bitwiseAND(F.bitwise_not(F.coalesce(f"full_{w}", F.lit(0).cast("bigint")))).alias(f"on_{w}")
            for w in period.words
        ),
    )
    sums = used.unionByName(gaps).groupBy("order_id", "device_type").agg(
        F.sum("amount").alias("amount"),
        F.sum("amounts").alias("amounts"),
        *(F.bit_or(f"on_{w}").alias(f"on_{w}") for w in period.words),
    )
    count = F.lit(0)
    for w in period.words:
        count = count + F.bit_count(f"on_{w}")
    return sums.select(
        "order_id", "device_type", F.when(F.col("amounts") > 0, F.col("amount")).cast("double").alias("consumption"),
        count.cast("bigint").alias("days"),
    ).filter("days > 0")
