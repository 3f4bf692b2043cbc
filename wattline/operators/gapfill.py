"""Filling the hours a device was silent.

Two readings of one clock hour are less than an hour apart, so a gap of an hour or more always
lies between the last reading of one hour and the first reading of the next hour that has any.
The neighbour window therefore runs over one row per device and *hour* (at most 8,784 a year),
made by a map-side aggregate, and never over raw readings; the readings themselves are not
shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattline.functions.scalars import as_double, smaller
from wattline.functions.timecols import (
    hour_floor,
    hours_after,
    interval,
    steps_between,
    whole_hours_between,
)
from wattline.operators.lookup import lookup_join
from wattline.operators.reduce import first_and_last
from wattline.schemas import FLAGS, TRIPLE


def _hour_ends(df: DataFrame, time: str, payload: list[str], keys: list[str], unique_times: bool):
    """First and last record per key and clock hour."""
    hours = df.withColumn("_hour", hour_floor(F.col(time)))
    return first_and_last(hours, [*keys, "_hour"], time, payload, unique_times)


def _in_time_order(keys: list[str], time: str) -> WindowSpec:
    """Window over one device; the hash in front shortens the comparisons of its sort."""
    return Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(time)


def gaps_after(
    df: DataFrame,
    time: str = "ts",
    payload: list[str] | None = None,
    keys: list[str] | None = None,
    unique_times: bool = False,
) -> DataFrame:
    """Readings followed by a gap of more than one whole hour.

    Returns the reading, ``next_time`` of the same device, and ``diff``, the whole hours between.
    """
    keys, payload = keys or TRIPLE, payload or ["value", *FLAGS]
    w = _in_time_order(keys, "_hour")
    ends = _hour_ends(df, time, payload, keys, unique_times)
    return (
        ends.withColumn("next_time", F.lead(f"first.{time}").over(w))
        .select(*keys, "last.*", "next_time")
        .withColumn("diff", whole_hours_between(F.col(time), F.col("next_time")).cast("int"))
        .filter("diff > 1")
    )


def fill_forward(
    df: DataFrame,
    time: str = "ts",
    payload: list[str] | None = None,
    keys: list[str] | None = None,
    unique_times: bool = False,
) -> DataFrame:
    """The readings plus one row per missing whole hour with the values of the reading before."""
    keys, payload = keys or TRIPLE, payload or ["value", *FLAGS]
    columns = [*keys, time, *payload]
    added = gaps_after(df, time, payload, keys, unique_times).withColumn(
        time, F.explode(hours_after(F.col(time), F.col("diff") - 1))
    )
    return df.select(*columns).unionByName(added.select(*columns))


def hours_between_readings(
    df: DataFrame, time: str = "ts", unique_times: bool = False, seed: DataFrame | None = None
) -> DataFrame:
    """Only the added rows of :func:`fill_between`.

    ``seed`` (device triple, ``seed_time``, ``seed_value``; one row per device) is what the first
    reading of a device is compared with.
    """
    w = _in_time_order(TRIPLE, "_hour")
    ends = _hour_ends(df, time, ["value", *FLAGS], TRIPLE, unique_times)
    before_time, before_value = F.lag(f"last.{time}").over(w), F.lag("last.value").over(w)
    if seed is not None:
        ends = lookup_join(ends, seed, TRIPLE)
        before_time = F.coalesce(before_time, F.col("seed_time"))
        before_value = F.coalesce(before_value, F.col("seed_value"))
    filled = (
        ends.withColumns({"before_time": before_time, "before_value": before_value})
        .filter(F.col("before_time") + interval(hours=1) < F.col(f"first.{time}"))
        .withColumn(
            time,
            F.explode(steps_between(F.col("before_time"), F.col(f"first.{time}"), interval(hours=1))),
        )
    )
    return filled.select(
        *TRIPLE,
        time,
        smaller(F.col("before_value"), F.col("first.value")).alias("value"),
        *(f"first.{c}" for c in FLAGS),
    )


def fill_between(df: DataFrame, time: str = "ts", unique_times: bool = False) -> DataFrame:
    """The readings plus rows at previous + 1 h, + 2 h ... strictly before each reading, with the
    smaller of both values and the flags of the later reading."""
    columns = [*TRIPLE, time, "value", *FLAGS]
    return df.select(*columns).unionByName(
        hours_between_readings(df, time, unique_times).select(*columns)
    )


def numeric_only(df: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose text spells a number, with that number."""
    return df.withColumn(column, as_double(F.col(column))).filter(F.col(column).isNotNull())


def fill_incremental(
    new: DataFrame, last_known: DataFrame, time: str = "ts", unique_times: bool = False
) -> tuple[DataFrame, DataFrame]:
    """:func:`fill_between` over a new load, started from the last reading of earlier loads.

    ``last_known`` has one row per device: the triple, ``time`` and ``value`` as text. A device
    whose stored value is not a number gets no rows and keeps its stored value; one without a
    stored value starts anew. Returns the rows to add and the new last-known table.
    """
    stored = last_known.select(*TRIPLE, time, F.col("value").cast("string").alias("value")).filter(
        F.col(time).isNotNull() & F.col("value").isNotNull()
    )
    spoiled = stored.filter(as_double(F.col("value")).isNull())
    usable = lookup_join(
        new.select(*TRIPLE, time, "value", *FLAGS), spoiled.select(*TRIPLE), TRIPLE, "left_anti"
    )
    seed = numeric_only(stored).select(
        *TRIPLE, F.col(time).alias("seed_time"), F.col("value").alias("seed_value")
    )
    filled = hours_between_readings(usable, time, unique_times, seed)
    rows = usable.unionByName(filled)

    latest = (
        stored.withColumn("fresh", F.lit(0))
        .unionByName(
            usable.select(*TRIPLE, time, F.col("value").cast("string"), F.lit(1).alias("fresh"))
        )
        .groupBy(*TRIPLE)
        .agg(F.max(F.struct("fresh", time, "value")).alias("last"))
        .select(*TRIPLE, f"last.{time}", "last.value")
    )
    return rows, latest


def carry_forward(
    periods: DataFrame,
    until,
    time: str = "date_time_key",
    hours: int = 0,
    minutes: int = 0,
    max_steps: int | None = None,
) -> DataFrame:
    """One row per device and period up to ``until``: its own record, or the last one before.

    ``periods`` holds at most one record per device and period of the given length. Silence lasts
    up to ``max_steps`` periods when that is set, for ever otherwise. ``carried`` marks repeats.
    """
    step = interval(hours=hours, minutes=minutes)
    w = _in_time_order(TRIPLE, time)
    end = F.coalesce(F.lead(time).over(w), until + step)
    if max_steps is not None:
        end = F.least(end, F.col(time) + step * (max_steps + 1))
    reached = periods.withColumn("_end", end)
    at = F.explode(F.concat(F.array(F.col(time)), steps_between(F.col(time), F.col("_end"), step)))
    return reached.withColumn("_at", at).select(
        *TRIPLE,
        F.col("_at").alias(time),
        "value",
        *FLAGS,
        (F.col("_at") > F.col(time)).alias("carried"),
    )
