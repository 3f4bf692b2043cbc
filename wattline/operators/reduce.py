"""Reductions of readings per device and period.

Everything here is a grouped aggregate, so rows collapse on the map side before the shuffle and a
device that sends a third of all readings costs one row per task and period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from wattline.functions.scalars import exact_difference
from wattline.functions.timecols import day_ending, hour_floor, minute_floor
from wattline.schemas import FLAGS, TRIPLE


def group_records(df: DataFrame, keys: list[str]) -> GroupedData:
    """Group for aggregates over whole records, led by a hash of the keys.

    Record buffers are not fixed-width, so such an aggregate sorts its input by the group. A 64-bit
    number in front lets nearly every comparison end at the sort prefix; the keys that follow keep
    the groups exact.
    """
    return df.withColumn("_group", F.xxhash64(*keys)).groupBy("_group", *keys)


def first_and_last(
    df: DataFrame,
    keys: list[str],
    time: str,
    payload: list[str],
    unique_times: bool = False,
) -> DataFrame:
    """Earliest and latest record per group as structs ``first`` and ``last``.

    With ``unique_times`` the caller states that a group holds no two records of one time; then
    fixed-width ``min_by``/``max_by`` buffers run in a hash aggregate. Otherwise whole records are
    compared, so ties end the same way on every run, at the price of a sort before aggregation.
    """
    fields = [time, *payload]
    if not unique_times:
        record = F.struct(*fields)
        ends = group_records(df, keys).agg(F.min(record).alias("first"), F.max(record).alias("last"))
        return ends.drop("_group")
    picks = []
    for c in fields:
        picks += [
            F.min_by(c, time).alias(f"_first_{c}") if c != time else F.min(c).alias(f"_first_{c}"),
            F.max_by(c, time).alias(f"_last_{c}") if c != time else F.max(c).alias(f"_last_{c}"),
        ]
    return df.groupBy(*keys).agg(*picks).select(
        *keys,
        *(
            F.struct(*(F.col(f"_{end}_{c}").alias(c) for c in fields)).alias(end)
            for end in ("first", "last")
        ),
    )


def daily_consumption(
    hourly: DataFrame, time: str = "date_time_key", cut_hour: int = 11, unique_times: bool = True
) -> DataFrame:
    """Per business day and device: last minus first value, and the last value with its flags.

    ``value`` is a running meter total. Hourly tables hold one record per device and hour, hence
    ``unique_times``; pass False for raw readings.
    """
    return consumption_of(daily_ends(hourly, time, cut_hour, unique_times), time)


def daily_ends(
    hourly: DataFrame, time: str = "date_time_key", cut_hour: int = 11, unique_times: bool = True
) -> DataFrame:
    """The ``first`` and ``last`` record of every device and business day."""
    return first_and_last(
        hourly.withColumn("date_key", day_ending(F.col(time), cut_hour)),
        ["date_key", *TRIPLE],
        time,
        ["value", *FLAGS],
        unique_times,
    )


def merged_ends(parts: DataFrame) -> DataFrame:
    """:func:`daily_ends` of several loads as those of all their readings. Any order and any grouping of
    the loads gives the same rows, and a load that comes twice changes nothing."""
    keys = ["date_key", *TRIPLE]
    ends = group_records(parts, keys).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return ends.select(*keys, "first", "last")


def consumption_of(ends: DataFrame, time: str = "date_time_key") -> DataFrame:
    """Per device and business day last minus first value, and the last value with its flags."""
    return ends.select(
        *TRIPLE,
        exact_difference(F.col("last.value"), F.col("first.value")).alias("consumption"),
        F.col("last.value").alias("value"),
        "date_key",
        *(F.col(f"last.{c}").alias(c) for c in FLAGS),
    )


def hourly_best(readings: DataFrame, time: str = "ts") -> DataFrame:
    """:func:`hourly_max` with the time of each record."""
    best = F.max(F.struct("value", time, *FLAGS)).alias("best")
    hours = readings.withColumn("date_time_key", hour_floor(F.col(time)))
    return (
        group_records(hours, [*TRIPLE, "date_time_key"])
        .agg(best)
        .select(*TRIPLE, f"best.{time}", *(f"best.{c}" for c in FLAGS), "best.value", "date_time_key")
    )


def hourly_max(readings: DataFrame, time: str = "ts") -> DataFrame:
    """Per device and clock hour the record with the greatest value; the latest one on a tie."""
    return hourly_best(readings, time).drop(time)


def flagged_time(time: str) -> Column:
    """Time and both flags in one number that sorts by time first.

    The last record's flags come out of a plain ``max`` of it, which keeps the aggregate a hash
    aggregate over fixed-width buffers. A flag takes two bits: 0 is null, 1 false, 2 true.
    """
    online, scenario = (
        F.when(F.col(c).isNull(), 0).when(F.col(c), 2).otherwise(1).cast("bigint") for c in FLAGS
    )
    return F.unix_micros(time) * 16 + online * 4 + scenario


def flags_of(number: Column) -> list[Column]:
    """The flags in a :func:`flagged_time`."""
    bits = (F.shiftright(number, low).bitwiseAND(F.lit(3)) for low in (2, 0))
    return [F.when(b != 0, b == 2).alias(name) for name, b in zip(FLAGS, bits)]


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows in an order. Each task sorts out its own first; no full sort is made."""
    return df.orderBy(*order).limit(n)


def minute_camera_sum(readings: DataFrame, time: str = "ts") -> DataFrame:
    """Per space and minute the sum of counts; flags of the last record."""
    return (
        readings.groupBy("space_id", minute_floor(F.col(time)).alias("minute"))
        .agg(
            F.sum("value").cast("int").alias("value"),
            F.max(flagged_time(time)).alias("last"),
        )
        .select("space_id", "value", *flags_of(F.col("last")), F.col("minute").alias("ts"))
    )


def minute_first(readings: DataFrame, time: str = "ts") -> DataFrame:
    """Per device and minute the first record of the minute."""
    first = F.min(F.struct(time, "value", *FLAGS)).alias("first")
    minutes = readings.withColumn("minute", minute_floor(F.col(time)))
    return (
        group_records(minutes, [*TRIPLE, "minute"])
        .agg(first)
        .select(*TRIPLE, "first.value", *(f"first.{c}" for c in FLAGS), F.col("minute").alias("ts"))
    )


def latest_by_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One record per key, the one loaded last; copies collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c != order]
    return (
        group_records(df, keys)
        .agg(F.max(F.struct(order, *rest)).alias("last"))
        .select(*keys, *(f"last.{c}" for c in rest), f"last.{order}")
    )


def map_sums(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Per group one map: the values of equal map keys, added over all its rows.

    Entries are summed per group and map key with map-side combine, and the map is built from sums. So
    what a group costs is its different map keys, not its rows. Null maps and empty ones add nothing; a
    group of only such maps has an empty map; null values count as absent.
    """
    entries = df.select(*keys, F.explode_outer(column).alias("_name", "_amount"))
    sums = entries.groupBy(*keys, "_name").agg(F.sum("_amount").alias("_amount"))
    pair = F.when(F.col("_name").isNotNull(), F.struct("_name", "_amount"))
    return sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(pair)).alias(column))
