"""The provided star-schema tables seen as telemetry, registry and booking tables.

Reading, meter and booking views keep every row of their table. The remainders below only decide
what a device or booking *is* (its type, whether the registry or the master table lists it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.functions.timecols import hour_floor
from wattline.schemas import to_session_ts
from wattline.sources.readers import since

_LONG = "bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _user(n: int) -> Column:
    return F.pmod(F.col("user_id"), F.lit(n).cast(_LONG))


def device_ids() -> list[Column]:
    return [
        _user(50).alias("space_id"),
        F.col("user_id").alias("zone_device_id"),
        (F.col("user_id") + 1000).alias("zone_device_control_id"),
    ]


def _device_type() -> Column:
    return (
        F.when(_user(4) == 0, "elemeter")
        .when(_user(4) == 1, "watermeter")
        .when(_user(4) == 2, "camera")
        .otherwise("airpurifiercontrol")
    )


def _device_tag() -> Column:
    return F.when(_user(4) == 2, 1010).when(_user(4) == 3, 1050).otherwise(1020)


def events(spark: SparkSession, sf_dir: str, start: str | None = None) -> DataFrame:
    """Events with session-zone timestamps; ``start`` is compared in the stored type, by the scan."""
    stored = table(spark, sf_dir, "events")
    return to_session_ts(since(stored, "ts", start) if start else stored)


def readings(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Raw readings, the value as text."""
    return readings_of(events(spark, sf_dir), keep)


def readings_of(events_df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return events_df.select(
        *(keep or []),
        *device_ids(),
        "ts",
        (F.col("event_type") != "error").alias("is_online"),
        (F.col("event_type") == "signup").alias("is_scenario"),
        _reading_text().alias("value"),
    )


def _reading_text() -> Column:
    """Cameras report counts, all others decimals."""
    count = F.floor("value").cast("int").cast("string")
    return F.when(_user(4) == 2, count).otherwise(F.col("value").cast("string"))


def numeric_readings(spark: SparkSession, sf_dir: str, start: str | None = None) -> DataFrame:
    """Readings with the value as a number."""
    return numeric_readings_of(events(spark, sf_dir, start))


def numeric_readings_of(events_df: DataFrame) -> DataFrame:
    return readings_of(events_df).withColumn("value", F.col("value").cast("double"))


def camera_readings_of(events_df: DataFrame) -> DataFrame:
    """Camera messages: a count per space, without a device."""
    return events_df.select(
        _user(50).alias("space_id"),
        "ts",
        F.floor("value").cast("int").alias("value"),
        (F.col("event_type") != "error").alias("is_online"),
        (F.col("event_type") == "signup").alias("is_scenario"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream. The name is a glob so that it may be a file or a folder."""
    path = f"{sf_dir.rstrip('/')}/events.parque[t]"
    schema = table(spark, sf_dir, "events").schema
    return to_session_ts(spark.readStream.schema(schema).parquet(path))


def meter_totals_of(events_df: DataFrame) -> DataFrame:
    """Hourly running meter totals, one row per device and hour."""
    w = Window.partitionBy("user_id").orderBy("date_time_key")
    used = (
        events_df.groupBy("user_id", hour_floor(F.col("ts")).alias("date_time_key"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("used"))
        .withColumn("total", F.sum("used").over(w))
    )
    return used


def meter_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meter_totals_of(events(spark, sf_dir)).select(
        *device_ids(),
        "date_time_key",
        F.lit(True).alias("is_online"),
        F.lit(False).alias("is_scenario"),
        F.col("total").cast("double").alias("value"),
    )


def space_hourly(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """Hourly use per device as the booking report reads it, moved back by whole days."""
    return meter_totals_of(events(spark, sf_dir)).select(
        *device_ids(),
        (F.col("date_time_key") - F.make_dt_interval(F.lit(shift_days))).alias("date_time_key"),
        F.col("used").cast("double").alias("accumulate_value"),
        F.col("total").cast("double").alias("current_value"),
        _device_type().alias("device_type"),
        F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("zone_device_code"),
    )


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id").distinct()


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _users(spark, sf_dir)
        .filter(_user(5) != 0)
        .select(*device_ids(), _device_type().alias("device_type"), _device_tag().alias("zone_device_control_tag"))
    )


def invalid_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(spark, sf_dir).filter(_user(20) == 0).select(*device_ids())


def binding_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _users(spark, sf_dir)
        .filter(_user(10) != 0)
        .select(
            *device_ids(),
            _device_type().alias("device_type_c"),
            _device_tag().alias("zone_device_control_tag"),
            F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("zone_device_code"),
        )
    )


def spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select(_user(50).alias("id")).distinct()
    return ids.select(
        "id",
        F.when(F.col("id") < 40, "room").otherwise("public").alias("type_c"),
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("code"),
    )


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    stay = F.make_dt_interval(F.pmod("o_orderkey", F.lit(120).cast(_LONG)).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("order_number"),
        F.col("o_custkey").alias("user_id"),
        F.pmod("o_custkey", F.lit(50).cast(_LONG)).alias("space_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "owner").otherwise("tenant").alias("order_type_c"),
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "active")
        .otherwise("rerenting")
        .alias("status_c"),
        F.col("o_orderdate").alias("check_in_date"),
        (F.col("o_orderdate") + stay).alias("check_out_date"),
    )


def booking_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    moved = F.pmod(F.col("o_custkey") + 1, F.lit(50).cast(_LONG)).cast("string")
    return (
        table(spark, sf_dir, "orders")
        .filter(key % 7 == 0)
        .select(key.alias("order_id"), F.when(key % 14 == 0, "").otherwise(moved).alias("space_id"))
    )


def extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("start_date"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))).alias("end_date"),
        F.col("l_shipdate").alias("created_at"),
        F.when(F.col("l_returnflag") == "R", "canceled").otherwise("active").alias("status_c"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("display_name")
    )


def wide_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading with the 34 columns of the warehouse table behind the wide export."""
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        *device_ids(),
        ts.alias("event_datetime"),
        (F.col("event_type") != "error").alias("is_online"),
        F.col("value").alias("current_value"),
        (F.col("value") / 2).alias("average_value"),
        *(
            part(ts).cast(_LONG).alias(name)
            for name, part in [
                ("year", F.year), ("month", F.month), ("day", F.dayofmonth),
                ("hour", F.hour), ("minute", F.minute), ("second", F.second),
            ]
        ),
        _user(10).alias("zone_id"),
        (F.col("user_id") + 2000).alias("control_id"),
        _device_tag().alias("zone_device_control_tag"),
        F.concat(F.lit("ctl-"), F.col("user_id").cast("string")).alias("zone_device_control_code"),
        F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("zone_device_code"),
        F.col("event_type").alias("control_value_type_c"),
        F.concat(F.lit("Z"), _user(10).cast("string")).alias("zone_code"),
        _user(3).alias("project_id"),
        F.concat(F.lit("R"), _user(50).cast("string")).alias("space_code"),
        F.when(_user(50) < 40, "room").otherwise("public").alias("space_type_c"),
        F.concat(F.lit("P"), _user(3).cast("string")).alias("project_code"),
        (_user(50) >= 40).alias("is_community"),
        (F.col("event_type") == "signup").alias("is_scenario"),
        F.col("value").alias("accumulate_value"),
        F.col("value").alias("last_value"),
        F.lit(60).alias("frequency"),
        F.to_date(ts).alias("date_key"),
        hour_floor(ts).alias("date_time_key"),
        ts.alias("created_at"),
        F.col("event_id").alias("device_id"),
        _device_type().alias("device_type"),
    )
