"""One registered query per operator and job, each over the whole provided tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce as fold
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions import scalars as sc
from wattline.functions import timecols as tc
from wattline.operators import bookings as bk
from wattline.operators import enrich, gapfill, history, reduce, targets
from wattline.operators.lookup import BROADCAST_BYTES, settle
from wattline.plans import jobs
from wattline.schemas import READING, TRIPLE
from wattline.sources import readers, registry, sample_views as v, writers
from wattline.streaming import carry, corrections, ingest, run, windows
from wattline.streaming import jobs as stream_jobs
from wattline.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BOOKING_AS_OF = "1998-06-30"
PERIOD = bk.Period(BOOKING_AS_OF)
# Moves the readings of January 2024 into the booking window.
SHIFT_DAYS = 9346
AS_OF = "2024-01-15"
RUN_TS = "2024-02-01 00:00:00"
START = "2020-02-15"
WIDE_DAY = "2024-01-05"
ISO_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def query(key: str) -> Callable[[Query], Query]:
    """Register a query. It runs in UTC and gives zone-less timestamps."""

    def register(build: Query) -> Query:
        @wraps(build)
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return schemas.to_ntz(build(spark, sf_dir))

        QUERIES[key] = wrapped
        return wrapped

    return register


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def _booking_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    return (
        v.bookings(spark, sf),
        v.booking_history(spark, sf),
        v.extensions(spark, sf),
        v.users(spark, sf),
        v.spaces(spark, sf),
    )


def _device_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    return v.registry(spark, sf), v.invalid_registry(spark, sf), v.binding_master(spark, sf)


def _raw_struct():
    camel = {snake: name for name, snake in schemas.SNAKE_NAMES.items()}
    names = [*TRIPLE, "ts", "is_online", "value", "is_scenario"]
    return F.struct(*(F.col(n).alias(camel.get(n, n)) for n in names))


def _raw_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Readings as the JSON texts a device gateway sends."""
    return v.readings(spark, sf).select(F.to_json(_raw_struct(), ISO_MICROS).alias("value"))


# -- sources ------------------------------------------------------------------------------------


@query("stream_read_json")
def stream_read_json(spark, sf):
    folder = new_folder(spark, "messages")
    _raw_messages(spark, sf).write.text(f"{folder}/in")
    parsed = readers.read_stream(spark, "text", {"path": f"{folder}/in"})
    return run.drain(spark, enrich.flatten(parsed), folder)


@query("scan_fixed_schema")
def scan_fixed_schema(spark, sf):
    declared = (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    )
    return readers.scan(spark, schema=declared, path=f"{sf}/events.parquet")


@query("scan_inferred_schema")
def scan_inferred_schema(spark, sf):
    return readers.scan(spark, path=f"{sf}/orders.parquet")


@query("registry_scan")
def registry_scan(spark, sf):
    devices = v.registry(spark, sf)
    kinds = enrich.kind_of(F.col("device_type"))
    names = F.create_map(*(F.lit(x) for p in enrich.REGISTRY_TABLES.items() for x in p))
    rows = devices.select(names[kinds].alias("table"), sc.device_key().alias("key"), "*")
    # Every table also holds rows under a plain number, which the scan leaves out.
    rows = rows.unionByName(rows.withColumn("key", F.col("zone_device_id").cast("string")))
    root = new_folder(spark, "registry")
    writers.write_registry(rows, root, "0")
    return readers.registry_scan(spark, root, "table=DEVICE_*").select(
        "_id", *TRIPLE, "device_type", "zone_device_control_tag"
    )


@query("dated_table_scan")
def dated_table_scan(spark, sf):
    at = F.col("date_time_key")
    table = v.meter_totals_of(v.events(spark, sf)).select(
        F.to_date(at).alias("date_key"),
        at,
        at.alias("create_at"),
        F.col("total").cast("double").alias("current_value"),
        F.col("used").cast("double").alias("difference"),
        *v.device_ids(),
        F.lit(True).alias("is_online"),
        F.lit(False).alias("is_scenario"),
        F.date_format(at, "HH:mm:ss").alias("time_key"),
    )
    folder = new_folder(spark, "dated")
    writers.append(table, folder, partition_by=["date_key"])
    return readers.dated_scan(spark, folder, date.fromisoformat(AS_OF), 1, table.columns)


@query("ragged_messages")
def ragged_messages(spark, sf):
    """Readings of messages of which some have numbers as text, lack a field, or are no JSON."""
    return enrich.flatten(readers.parse_ragged(_ragged(spark, sf)).filter("data is not null"))


def _ragged(spark: SparkSession, sf: str) -> DataFrame:
    """Messages by the last digit of the event: 0 cut short, 1 without device, 2 numbers as text."""
    r = v.readings(spark, sf, ["event_id"])
    whole = F.to_json(F.struct(
        F.col("space_id").alias("spaceId"), F.col("zone_device_id").alias("zoneDeviceId"),
        F.col("zone_device_control_id").alias("zoneDeviceControlId"), tc.format_time(F.col("ts")).alias("ts"),
        F.col("is_online").alias("isOnline"), "value", F.col("is_scenario").alias("isScenario"),
    ))
    texts = F.to_json(F.struct(
        F.col("space_id").cast("string").alias("spaceId"), F.col("zone_device_id").cast("string").alias("zoneDeviceId"),
        F.col("zone_device_control_id").alias("zoneDeviceControlId"), tc.format_time(F.col("ts")).alias("ts"),
        F.col("is_online").cast("string").alias("isOnline"), F.col("value").cast("double").alias("value"),
        F.col("is_scenario").alias("isScenario"), F.lit(1).alias("more"),
    ))
    digit = F.col("event_id") % 10
    return r.select(
        F.when(digit == 0, F.concat(F.lit('{"event":'), F.col("event_id").cast("string")))
        .when(digit == 1, F.concat(F.lit('{"spaceId":1,"event":'), F.col("event_id").cast("string"), F.lit("}")))
        .when(digit == 2, texts)
        .otherwise(whole)
        .alias("value")
    )


@query("range_scan_count")
def range_scan_count(spark, sf):
    lo, hi = tc.day_range(F.lit(AS_OF).cast("date"))
    picked = readers.time_range(v.table(spark, sf, "events"), "ts", lo, hi)
    return picked.agg(F.count(F.lit(1)).alias("readings"))


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    """History responses with two reads each; error events give a response without data, signups
    the text of a failed request."""
    r = v.readings_of(v.events(spark, sf).withColumn("raw", F.col("value")), ["event_type", "raw"])
    full, half = _raw_struct(), F.struct(
        F.col("space_id").alias("spaceId"),
        F.col("zone_device_id").alias("zoneDeviceId"),
        F.col("zone_device_control_id").alias("zoneDeviceControlId"),
        (F.col("ts") + tc.interval(hours=1)).alias("ts"),
        F.col("is_online").alias("isOnline"),
        (F.col("raw") / 2).cast("string").alias("value"),
        F.col("is_scenario").alias("isScenario"),
    )
    body = F.to_json(F.struct(F.struct(F.array(full, half).alias("reads")).alias("data")), ISO_MICROS)
    return r.select(
        F.when(F.col("event_type") == "error", F.lit('{"message":"unknown device"}'))
        .when(F.col("event_type") == "signup", F.lit("Exception"))
        .otherwise(body)
        .alias("value")
    )


@query("history_json_reads")
def history_json_reads(spark, sf):
    return history.history_reads(_responses(spark, sf))


# -- sinks --------------------------------------------------------------------------------------


@query("sink_append")
def sink_append(spark, sf):
    folder = new_folder(spark, "facts")
    rows = v.numeric_readings(spark, sf).withColumn("date_key", F.to_date("ts"))
    writers.append(rows, folder, partition_by=["date_key"])
    return writers.retained(readers.scan(spark, path=folder), "ts", "2024-05-10 00:00:00").select(
        *READING
    )


@query("sink_expiry")
def sink_expiry(spark, sf):
    """Rows per date before and after the old dates have been removed, twice."""
    folder = new_folder(spark, "expiring")
    rows = v.numeric_readings(spark, sf).withColumn("date_key", F.to_date("ts"))
    writers.append(rows, folder, partition_by=["date_key"])
    count = lambda phase: readers.scan(spark, path=folder).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("rows")
    ).withColumn("phase", F.lit(phase))
    before = settle(count("before"))
    for _ in range(2):
        writers.expire_partitions(spark, folder, "2024-05-10 00:00:00")
    return before.unionByName(count("after"))


@query("upsert_latest")
def upsert_latest(spark, sf):
    folder = new_folder(spark, "hourly")
    first = v.meter_hourly(spark, sf).withColumns(
        {"load_seq": F.lit(0), "date_key": F.to_date("date_time_key")}
    )
    writers.append(first, folder, partition_by=["date_key"])
    second = first.filter(F.col("date_time_key") >= "2024-01-20").withColumns(
        {"value": F.col("value") + 1000, "load_seq": F.lit(1)}
    )
    writers.upsert(spark, second, folder, [*TRIPLE, "date_time_key"], "load_seq")
    return readers.scan(spark, path=folder).select(*TRIPLE, "date_time_key", "value", "load_seq")


@query("csv_export")
def csv_export(spark, sf):
    folder = new_folder(spark, "csv")
    rows = v.numeric_readings(spark, sf).withColumn("ts", tc.format_time(F.col("ts"), tc.MILLIS))
    writers.csv_export(rows.select(*READING), folder)
    schema = schemas.HISTORY_READING.replace("ts timestamp", "ts string")
    return readers.scan(spark, "csv", schema=schema, path=folder)


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.ingest(v.readings(spark, sf), *_device_tables(spark, sf))


@query("topic_publish_json")
def topic_publish_json(spark, sf):
    return enrich.messages(_routed(spark, sf))


@query("topic_publish_once")
def topic_publish_once(spark, sf):
    """A batch that was published twice, read back once."""
    folder = new_folder(spark, "topic")
    sent = enrich.messages(_routed(spark, sf), batch_id=7)
    for _ in range(2):
        writers.publish(sent, {"path": folder}, "parquet")
    stream = spark.readStream.schema(sent.schema).parquet(folder)
    body = schemas.METER_MESSAGE + ", batch bigint"
    once = run.drain(spark, readers.published_once(stream, body, "400 days"), new_folder(spark, "once"))
    return once.withColumn("value", F.regexp_replace("value", ',"batch":7}$', "}"))


@query("registry_upsert")
def registry_upsert(spark, sf):
    root = new_folder(spark, "registry")
    writers.write_registry(enrich.registry_rows(_routed(spark, sf)), root, "0")
    return readers.scan(spark, path=root).select(
        "table", "_id", *TRIPLE, "zone_device_control_tag", "device_type"
    )


# -- projections and filters --------------------------------------------------------------------


@query("flatten_rename")
def flatten_rename(spark, sf):
    parsed = _raw_messages(spark, sf).select(readers.parse_message(F.col("value")).alias("data"))
    return enrich.flatten(parsed)


@query("live_readings")
def live_readings(spark, sf):
    return enrich.live(v.readings(spark, sf))


@query("registry_type_tag_filter")
def registry_type_tag_filter(spark, sf):
    # Every device of the master table with each of the three control tags.
    tags = F.explode(F.array(F.lit(1010), F.lit(1020), F.lit(1050)))
    controls = v.binding_master(spark, sf).withColumn("zone_device_control_tag", tags)
    return enrich.relevant_devices(controls).withColumn(
        "meter", enrich.is_meter(F.col("device_type_c"), F.col("zone_device_control_tag"))
    )


@query("route_by_type")
def route_by_type(spark, sf):
    devices = enrich.known(enrich.enrich(enrich.live(v.readings(spark, sf)), v.registry(spark, sf)))
    routed = devices.withColumn("kind", enrich.kind_of(F.col("device_type")))
    return enrich.typed_values(routed).select(*TRIPLE, "ts", "kind", "value_double", "value_int")


@query("booking_filter")
def booking_filter(spark, sf):
    return bk.current_bookings(v.bookings(spark, sf), PERIOD)


@query("extension_filter")
def extension_filter(spark, sf):
    return bk.live_extensions(v.extensions(spark, sf), PERIOD)


@query("override_space")
def override_space(spark, sf):
    renamed = v.bookings(spark, sf).withColumnRenamed("id", "order_id")
    moved = bk.with_actual_space(renamed, v.booking_history(spark, sf))
    return moved.select("order_id", F.col("space_id").alias("actual_space_id"))


@query("null_predicates")
def null_predicates(spark, sf):
    route = F.col("route")
    parts = {
        "known": route == "known",
        "unknown": route != "known",
        "newly_known": route == "newly_known",
        "invalid": route == "invalid",
    }
    routed = enrich.classify(enrich.live(v.readings(spark, sf)), *_device_tables(spark, sf))
    counted = routed.agg(*(F.count_if(of_part).alias(name) for name, of_part in parts.items()))
    return counted.unpivot([], list(parts), "part", "readings")


@query("wide_export")
def wide_export(spark, sf):
    return jobs.wide_day_export(v.wide_readings(spark, sf), "watermeter", WIDE_DAY)


@query("alias_projection")
def alias_projection(spark, sf):
    return v.bookings(spark, sf).selectExpr(
        "id as order_id", "order_number", "user_id", "space_id as history_space_id",
        "order_type_c", "status_c", "check_in_date", "check_out_date",
    )


@query("room_filter")
def room_filter(spark, sf):
    return bk.rooms_only(v.spaces(spark, sf))


# -- joins --------------------------------------------------------------------------------------


@query("enrich_readings")
def enrich_readings(spark, sf):
    return enrich.enrich(v.readings(spark, sf), v.registry(spark, sf))


@query("unknown_minus_invalid")
def unknown_minus_invalid(spark, sf):
    registry, invalid, _ = _device_tables(spark, sf)
    unknown = enrich.unknown(enrich.enrich(v.readings(spark, sf), registry)).select(*READING)
    return enrich.not_yet_invalid(unknown, invalid)


@query("unknown_vs_master")
def unknown_vs_master(spark, sf):
    registry, invalid, master = _device_tables(spark, sf)
    unknown = enrich.unknown(enrich.enrich(v.readings(spark, sf), registry)).select(*READING)
    return enrich.resolve(enrich.not_yet_invalid(unknown, invalid), master)


@query("booking_history_join")
def booking_history_join(spark, sf):
    renamed = v.bookings(spark, sf).withColumnRenamed("id", "order_id")
    return bk.with_actual_space(renamed, v.booking_history(spark, sf)).select(
        "order_id", "order_number", "user_id", "space_id", "copies"
    )


def _booking_days(spark: SparkSession, sf: str) -> DataFrame:
    bookings, spaces = v.bookings(spark, sf), v.booking_history(spark, sf)
    return bk.booking_days(bk.with_actual_space(bk.current_bookings(bookings, PERIOD), spaces))


def _days_on_extension(spark: SparkSession, sf: str) -> DataFrame:
    live = bk.live_extensions(v.extensions(spark, sf), PERIOD)
    return bk.days_on_extension(_booking_days(spark, sf), live, PERIOD)


@query("booking_day_extension")
def booking_day_extension(spark, sf):
    return _days_on_extension(spark, sf).select("order_id", "space_id", "date", "on_rerent", "copies")


@query("booking_user_space")
def booking_user_space(spark, sf):
    named = bk.with_user_and_room(v.bookings(spark, sf), v.users(spark, sf), v.spaces(spark, sf))
    return named.select("id", "order_number", "user_id", "user_name", "space_id", "room")


@query("extension_count_join")
def extension_count_join(spark, sf):
    days = _days_on_extension(spark, sf)
    return bk.below_extension_limit(days, bk.extension_totals(days)).select(
        "order_id", "space_id", "date", "on_rerent"
    )


@query("readings_registered")
def readings_registered(spark, sf):
    return jobs.registered_only(v.meter_hourly(spark, sf), v.registry(spark, sf))


@query("daily_device_join")
def daily_device_join(spark, sf):
    daily = reduce.daily_consumption(v.meter_hourly(spark, sf))
    return jobs.with_device(daily, v.binding_master(spark, sf))


@query("daily_room_join")
def daily_room_join(spark, sf):
    daily = reduce.daily_consumption(v.meter_hourly(spark, sf))
    return jobs.with_room(daily, v.spaces(spark, sf))


def _hours(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.booking_hours(*_booking_inputs(spark, sf), BOOKING_AS_OF)


def _hours_with_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Times are cast once per hour and reading: after the join it would be once per pair of them."""
    hours, readings = _hours(spark, sf), v.space_hourly(spark, sf, SHIFT_DAYS)
    return targets.hours_with_readings(schemas.to_ntz(hours), schemas.to_ntz(readings))


@query("hours_with_readings")
def hours_with_readings(spark, sf):
    return _hours_with_readings(spark, sf).select(
        "order_id", "space_id", "date_time_key", "on_rerent", "zone_device_id", "device_type",
        "accumulate_value",
    )


# -- aggregations -------------------------------------------------------------------------------


@query("daily_consumption")
def daily_consumption(spark, sf):
    return reduce.daily_consumption(v.meter_hourly(spark, sf))


@query("hourly_max_reading")
def hourly_max_reading(spark, sf):
    return reduce.hourly_max(v.numeric_readings(spark, sf))


@query("minute_camera_sum")
def minute_camera_sum(spark, sf):
    return reduce.minute_camera_sum(v.camera_readings_of(v.events(spark, sf)))


@query("extension_day_count")
def extension_day_count(spark, sf):
    return bk.extension_totals(_days_on_extension(spark, sf))


def _hours_with_sums(spark: SparkSession, sf: str) -> DataFrame:
    sums = settle(targets.hourly_sums(v.space_hourly(spark, sf, SHIFT_DAYS)))
    return targets.hours_with_readings(_hours(spark, sf), sums, BROADCAST_BYTES)


@query("target_day_sum")
def target_day_sum(spark, sf):
    return targets.day_sums(_hours_with_sums(spark, sf))


@query("target_period_sum")
def target_period_sum(spark, sf):
    met = _hours_with_sums(spark, sf)
    return targets.period_sums(targets.day_sums(met))


@query("target_period_totals")
def target_period_totals(spark, sf):
    return jobs.consumption_from_totals(
        *_booking_inputs(spark, sf), v.space_hourly(spark, sf, SHIFT_DAYS), BOOKING_AS_OF
    )


@query("daily_consumption_loads")
def daily_consumption_loads(spark, sf):
    """Three loads, the middle one of them last, and one again."""
    folder = new_folder(spark, "daily-ends")
    hourly = v.meter_hourly(spark, sf)
    at = F.col("date_time_key")
    early, late = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 07:00:00", "2024-01-20 15:00:00"))
    loads = [hourly.filter(at < early), hourly.filter(at >= late), hourly.filter((at >= early) & (at < late))]
    for load in (*loads, loads[0]):
        jobs.load_daily(spark, load, folder)
    return reduce.consumption_of(readers.scan(spark, path=folder))


@query("table_count")
def table_count(spark, sf):
    names = ["events", "orders", "lineitem", "customer"]
    counted = [
        readers.row_count(spark, f"{sf}/{n}.parquet").select(F.lit(n).alias("name"), "rows") for n in names
    ]
    # Each count is one row of a session of its own.
    rows = [tuple(c.first()) for c in counted]
    return spark.createDataFrame(rows, "name string, rows bigint")


@query("map_merge_sum")
def map_merge_sum(spark, sf):
    left = F.create_map(F.col("event_type"), F.lit(1), F.lit("all"), F.lit(1))
    right = F.create_map(F.lit("all"), F.lit(2), F.lit("error"), F.lit(3))
    merged = v.table(spark, sf, "events").select("event_id", sc.merge_counts(left, right).alias("m"))
    return merged.select("event_id", F.explode("m").alias("name", "amount"))


@query("map_group_sum")
def map_group_sum(spark, sf):
    """Event counts and amounts per device, first as a map per event."""
    events = v.table(spark, sf, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    maps = events.select(
        "user_id", F.create_map(F.col("event_type"), F.lit(1).cast("bigint"), F.lit("cents"), cents).alias("m")
    )
    return reduce.map_sums(maps, ["user_id"], "m").select("user_id", F.explode("m").alias("name", "amount"))


# -- windows and gap fill -----------------------------------------------------------------------


@query("next_reading_lead")
def next_reading_lead(spark, sf):
    return gapfill.gaps_after(v.numeric_readings(spark, sf))


@query("fill_forward_lead")
def fill_forward_lead(spark, sf):
    return gapfill.fill_forward(v.meter_hourly(spark, sf), "date_time_key", unique_times=True)


@query("fill_between_min")
def fill_between_min(spark, sf):
    return gapfill.fill_between(v.meter_hourly(spark, sf), "date_time_key", unique_times=True)


def _two_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = v.numeric_readings(spark, sf)
    return r.filter(F.col("ts") < AS_OF), r.filter(F.col("ts") >= AS_OF)


def _filled_on_state(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    old, new = _two_loads(spark, sf)
    last_known = (
        old.groupBy(*TRIPLE)
        .agg(F.max(F.struct("ts", "value")).alias("last"))
        .select(
            *TRIPLE,
            "last.ts",
            # Devices of space 7 have a stored value that is not a number.
            F.when(F.col("space_id") == 7, "n/a").otherwise(F.col("last.value").cast("string")).alias("value"),
        )
    )
    return gapfill.fill_incremental(new, last_known)


@query("fill_incremental")
def fill_incremental(spark, sf):
    return _filled_on_state(spark, sf)[0]


@query("fill_incremental_state")
def fill_incremental_state(spark, sf):
    return _filled_on_state(spark, sf)[1]


@query("fill_incremental_load")
def fill_incremental_load(spark, sf):
    folder = new_folder(spark, "loads")
    for load, readings in enumerate(_two_loads(spark, sf)):
        jobs.load_hours(spark, readings, load, f"{folder}/table", f"{folder}/state")
    return readers.scan(spark, path=f"{folder}/table").select(
        *TRIPLE, "date_time_key", "value", *schemas.FLAGS
    )


@query("numeric_guard")
def numeric_guard(spark, sf):
    spoiled = F.when(F.col("is_online"), F.col("value")).otherwise(F.lit("n/a"))
    return gapfill.numeric_only(v.readings(spark, sf).withColumn("value", spoiled))


# -- sorts, sets and generators -----------------------------------------------------------------


@query("sort_multi_key")
def sort_multi_key(spark, sf):
    return reduce.top_rows(v.meter_hourly(spark, sf), [F.desc("date_time_key"), *TRIPLE], 100)


@query("sort_by_key_reduce")
def sort_by_key_reduce(spark, sf):
    ends = reduce.first_and_last(v.numeric_readings(spark, sf), TRIPLE, "ts", ["value"])
    return ends.select(
        *TRIPLE,
        F.col("first.ts").alias("first_ts"),
        F.col("first.value").alias("first_value"),
        F.col("last.ts").alias("last_ts"),
        F.col("last.value").alias("last_value"),
    )


@query("distinct_devices")
def distinct_devices(spark, sf):
    return readers.distinct_devices(v.readings(spark, sf))


@query("distinct_rows")
def distinct_rows(spark, sf):
    return v.meter_hourly(spark, sf).select("space_id", "date_time_key").distinct()


@query("union_all")
def union_all(spark, sf):
    hourly = v.meter_hourly(spark, sf).withColumnRenamed("date_time_key", "ts")
    return v.numeric_readings(spark, sf).unionByName(hourly)


@query("explode_days")
def explode_days(spark, sf):
    ext = bk.local_bounds(v.extensions(spark, sf), "start_date", "end_date")
    once = bk.extension_days(ext).groupBy("date").agg(F.count(F.lit(1)).alias("days"))
    twice = bk.extension_days(ext, repeat_start=True).groupBy("date").agg(
        F.count(F.lit(1)).alias("days_with_repeated_start")
    )
    return once.join(twice, "date", "full")


@query("explode_hours")
def explode_hours(spark, sf):
    return bk.booking_hours(_booking_days(spark, sf)).select("order_id", "space_id", "date", "date_time_key")


@query("range_replay")
def range_replay(spark, sf):
    return reduce.daily_consumption(jobs.day_readings(v.meter_hourly(spark, sf), AS_OF, days=10))


# -- scalar functions ---------------------------------------------------------------------------


def _ts(spark: SparkSession, sf: str) -> DataFrame:
    return v.events(spark, sf)


@query("time_parse_format")
def time_parse_format(spark, sf):
    text = tc.format_time(F.col("ts"))
    millis = tc.parse_millis(text)
    return _ts(spark, sf).select(
        "event_id",
        text.alias("text"),
        millis.alias("millis"),
        tc.format_millis(millis, tc.MILLIS).alias("from_millis"),
        tc.format_millis(millis.cast("string"), "HH").alias("hour_of_millis"),
        tc.reformat(text, tc.SECONDS, "yyyyMMddHHmmss").alias("compact"),
        tc.parse(text).alias("parsed"),
        tc.format_time(F.to_date("ts"), "yyyy-MM-dd").alias("date_text"),
    )


@query("time_add")
def time_add(spark, sf):
    ts = F.col("ts")
    return _ts(spark, sf).select(
        "event_id",
        tc.format_time(tc.shift(ts, days=-3), "yyyyMMdd").alias("add_date"),
        tc.shift(ts, days=40).alias("add_days"),
        tc.shift(ts, hours=8).alias("add_hours"),
        tc.shift(ts, minutes=-90).alias("add_minutes"),
        tc.shift(ts, seconds=3601).alias("add_seconds"),
    )


@query("time_add_floor")
def time_add_floor(spark, sf):
    ts = F.col("ts")
    return _ts(spark, sf).select(
        "event_id",
        tc.shift_hours_zero_minute(ts, 5).alias("hours_zero_minute"),
        tc.shift_minutes_zero_second(ts, -7).alias("minutes_zero_second"),
        tc.next_minute(ts).alias("next_minute"),
        tc.next_hour(ts).alias("next_hour"),
        tc.next_ten_minutes(ts).alias("next_ten_minutes"),
    )


@query("time_floor")
def time_floor(spark, sf):
    ts = F.col("ts")
    return _ts(spark, sf).select(
        "event_id",
        tc.hour_floor(ts).alias("hour"),
        tc.minute_floor(ts).alias("minute"),
        tc.epoch_minute(F.unix_millis(ts)).alias("epoch_minute"),
    )


@query("time_keys")
def time_keys(spark, sf):
    ts = F.col("ts")
    return _ts(spark, sf).select(
        "event_id",
        tc.dashed_time_key(ts).alias("time_key"),
        tc.dashed_hour_key(ts).alias("hour_key"),
        tc.compact_hour_key(ts).alias("compact_hour_key"),
        tc.date_key(ts).alias("date_key"),
    )


@query("time_diff")
def time_diff(spark, sf):
    ts, fixed = F.col("ts"), F.lit("2024-01-15 12:00:00").cast("timestamp")
    return _ts(spark, sf).select(
        "event_id",
        tc.seconds_between(F.date_trunc("second", ts), fixed).alias("seconds"),
        tc.whole_hours_between(ts, fixed).alias("hours"),
        tc.days_between(ts, fixed).alias("days"),
        tc.days_since_anniversary(F.lit(1), F.lit(20), F.to_date(ts)).alias("since_20_january"),
    )


@query("time_compare")
def time_compare(spark, sf):
    ts = F.col("ts")
    lo, hi = (F.lit(f"2024-01-{d} 12:00:00").cast("timestamp") for d in (10, 20))
    only_clicks = F.when(F.col("event_type") == "click", hi)
    return _ts(spark, sf).select(
        "event_id",
        tc.within(ts, lo, hi).alias("within"),
        tc.within(ts, lo, only_clicks).alias("within_or_null"),
        tc.not_after(ts, hi).alias("not_after"),
        tc.before(ts, hi).alias("before"),
    )


@query("business_day")
def business_day(spark, sf):
    ts = F.col("ts")
    return _ts(spark, sf).select(
        "event_id",
        tc.day_ending(ts).alias("ending_11"),
        tc.day_starting(ts).alias("starting_12"),
        tc.in_day_of(ts, F.lit(AS_OF).cast("date")).alias("in_day"),
    )


@query("day_bounds")
def day_bounds(spark, sf):
    ts = F.col("ts")
    return _ts(spark, sf).select(
        "event_id",
        tc.cut_of(ts, 12, -1).alias("yesterday_12"),
        tc.cut_of(ts, 11, -1).alias("yesterday_11"),
        tc.cut_of(ts, 12).alias("today_12"),
    )


@query("time_lists")
def time_lists(spark, sf):
    ts = F.date_trunc("second", "ts")
    to_day = F.lit("2024-01-15").cast("timestamp")

    def dates(xs):
        return F.array_join(F.transform(xs, lambda d: F.date_format(d, "yyyy-MM-dd")), "|")

    def times(xs):
        return F.array_join(F.transform(xs, lambda t: F.date_format(t, tc.SECONDS)), "|")

    return _ts(spark, sf).select(
        "event_id",
        dates(tc.dates_between(ts, to_day)).alias("dates"),
        dates(tc.dates_between(ts, to_day, repeat_start=True)).alias("dates_repeated"),
        times(tc.hours_of_day(ts)).alias("booking_hours"),
        times(tc.steps_between(ts, tc.next_hour(tc.shift(ts, hours=4)), tc.interval(hours=1))).alias("between"),
        times(tc.hours_after(ts, F.pmod("event_id", F.lit(5).cast("bigint")).cast("int"))).alias("after"),
        dates(tc.past_days(ts, 4)).alias("past_days"),
        times(tc.past_hours(ts, 3, 6)).alias("past_hours"),
    )


@query("device_key")
def device_key(spark, sf):
    keyed = v.readings(spark, sf, ["event_id"]).select("event_id", sc.device_key().alias("key"))
    return keyed.select("event_id", "key", *sc.split_device_key(F.col("key")))


@query("numeric_check")
def numeric_check(spark, sf):
    text = (
        F.when(F.col("is_scenario"), F.concat(F.lit(" "), "value"))
        .when(F.col("is_online"), F.col("value"))
        .otherwise(F.lit("n/a"))
    )
    return v.readings(spark, sf, ["event_id"]).select(
        "event_id", text.alias("text"), sc.is_int(text).alias("is_int"), sc.is_double(text).alias("is_double")
    )


@query("json_fields")
def json_fields(spark, sf):
    parsed = F.from_json("props", "k int")
    return v.table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query("json_encode")
def json_encode(spark, sf):
    r = v.readings(spark, sf, ["event_id"]).withColumn("ts", tc.format_time(F.col("ts")))
    body = F.struct(*TRIPLE, "ts", "is_online", "value", "is_scenario")
    return r.select("event_id", F.to_json(body).alias("json"))


@query("least_value")
def least_value(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", sc.smaller(F.col("l_quantity"), F.lit(25.0)).alias("smaller")
    )


@query("decimal_delta")
def decimal_delta(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id",
        sc.exact_difference(F.col("value"), F.lit(0.1)).alias("difference"),
        (sc.exact(F.col("value")) + sc.exact(F.lit(0.2))).cast("double").alias("sum"),
    )


@query("date_builtins")
def date_builtins(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        F.datediff(PERIOD.last, "o_orderdate").alias("age_days"),
        F.date_sub("o_orderdate", 30).alias("month_before"),
        (F.datediff(PERIOD.first, "o_orderdate") >= 0).alias("before_window"),
    )


@query("string_contains")
def string_contains(spark, sf):
    keyed = v.registry(spark, sf).withColumn(
        "_id", F.when(F.col("space_id") < 10, F.col("zone_device_id").cast("string")).otherwise(sc.device_key())
    )
    return keyed.filter(sc.has_dash(F.col("_id"))).select("_id", *TRIPLE)


# -- streams ------------------------------------------------------------------------------------


def _job_table(spark: SparkSession, job: Callable, readings: DataFrame, **options) -> DataFrame:
    """The dated table a stream job makes of readings that come as JSON texts."""
    folder = new_folder(spark, "job")
    body = F.struct(*(F.col(c).cast("string").alias(c) if c == "ts" else c for c in readings.columns))
    readings.select(F.to_json(body).alias("value")).write.text(f"{folder}/in")
    started = job(
        readers.read_messages(spark, "text", {"path": f"{folder}/in"}),
        f"{folder}/out",
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
        partitions=spark.sparkContext.defaultParallelism,
        **options,
    )
    started.awaitTermination()
    return readers.scan(spark, path=f"{folder}/out").drop("date_key")


@query("stream_hourly_meter")
def stream_hourly_meter(spark, sf):
    readings = v.numeric_readings_of(v.event_stream(spark, sf))
    return run.drain(spark, windows.hourly_meter(readings).drop("closed_at"), new_folder(spark, "hourly"))


@query("stream_minute_camera")
def stream_minute_camera(spark, sf):
    return _job_table(spark, stream_jobs.minute_camera, v.camera_readings_of(v.events(spark, sf)))


@query("stream_minute_co2")
def stream_minute_co2(spark, sf):
    """Every minute of every sensor, summed up per device and hour from the stored runs."""
    runs = _job_table(spark, stream_jobs.minute_co2, v.numeric_readings(spark, sf), as_runs=True)
    return carry.hours_of_runs(runs)


@query("stream_carry_forward")
def stream_carry_forward(spark, sf):
    return _job_table(spark, stream_jobs.hourly_meter, v.numeric_readings(spark, sf))


@query("stream_state_handover")
def stream_state_handover(spark, sf):
    """The table of two streams, the second of which starts anew from what the first one wrote."""
    readings = v.numeric_readings(spark, sf)
    cut = F.lit("2024-01-16 05:20:00").cast("timestamp")
    first = readings.filter(F.col("ts") < cut)
    done = settle(_job_table(spark, stream_jobs.hourly_meter, first))
    # Hours that the first stream had not closed come again.
    newest = first.agg(F.max("ts")).first()[0]
    opened = F.date_trunc("hour", F.lit(newest).cast("timestamp") - tc.interval(minutes=10))
    rest = readings.filter(F.col("ts") >= opened)
    initial = carry.last_states(done, "date_time_key")
    return done.unionByName(_job_table(spark, stream_jobs.hourly_meter, rest, initial=initial))


@query("stream_late_correction")
def stream_late_correction(spark, sf):
    """Hours of three loads that each reach over the whole time, with a restart after each."""
    root, source = new_folder(spark, "corrected"), new_folder(spark, "late")
    readings = v.readings(spark, sf, ["event_id"]).withColumn("value", F.col("value").cast("double"))
    for load in range(3):
        part = readings.filter(F.col("event_id") % 3 == load).drop("event_id")
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        started = corrections.start_corrected_hours(
            stream, root, f"{root}/checkpoint", trigger={"availableNow": True}
        )
        started.awaitTermination()
    return corrections.corrected_hours(spark, root)


@query("stream_refused")
def stream_refused(spark, sf):
    """The texts that ingest could not read."""
    folder = new_folder(spark, "ragged")
    _ragged(spark, sf).write.text(f"{folder}/in")
    raw = readers.read_messages(spark, "text", {"path": f"{folder}/in"})
    started = ingest.start_ingest(
        readers.parse_ragged(raw),
        _stored_tables(spark, sf, f"{folder}/devices"),
        ingest.Targets(f"{folder}/facts", f"{folder}/devices", refused=f"{folder}/refused"),
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
    )
    started.awaitTermination()
    return readers.scan(spark, path=f"{folder}/refused").select("refused")


def _stored_tables(spark: SparkSession, sf: str, devices: str) -> ingest.Tables:
    """The device tables of a stream that writes its own registry."""

    def registered(tables: str):
        return lambda s: registry.devices(s, devices, tables)

    return ingest.Tables(
        registry=registered("DEVICE_*"),
        invalid=registered(enrich.INVALID_TABLE),
        master=lambda s: v.binding_master(s, sf),
    )


def _ingested(spark: SparkSession, sf: str, seeded: bool) -> DataFrame:
    """Facts of all messages, from a registry that is filled or that has nothing yet."""
    folder = new_folder(spark, "ingest")
    _raw_messages(spark, sf).write.text(f"{folder}/in")
    devices = f"{folder}/devices"
    if seeded:
        known, invalid, _ = _device_tables(spark, sf)
        kinds = F.create_map(*(F.lit(x) for p in enrich.REGISTRY_TABLES.items() for x in p))
        seed = known.withColumn("table", kinds[enrich.kind_of(F.col("device_type"))]).unionByName(
            invalid.withColumn("table", F.lit(enrich.INVALID_TABLE)), allowMissingColumns=True
        )
        registry.write_unit(spark, seed.withColumn("key", sc.device_key()), devices, "seed")
        registry.compact(spark, devices)
    tables = _stored_tables(spark, sf, devices)
    messages = readers.read_stream(spark, "text", {"path": f"{folder}/in"})
    started = ingest.start_ingest(
        messages,
        tables,
        ingest.Targets(f"{folder}/facts", devices),
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
    )
    started.awaitTermination()
    return readers.scan(spark, path=f"{folder}/facts").select(*ingest.FACTS)


@query("stream_ingest")
def stream_ingest(spark, sf):
    return _ingested(spark, sf, seeded=True)


@query("stream_ingest_cold")
def stream_ingest_cold(spark, sf):
    return _ingested(spark, sf, seeded=False)


# -- jobs ---------------------------------------------------------------------------------------


@query("q_ingest_route")
def q_ingest_route(spark, sf):
    return _routed(spark, sf).select(
        *TRIPLE, "ts", "route", "kind", "device_type", "value_double", "value_int"
    )


@query("q_hourly_meter")
def q_hourly_meter(spark, sf):
    return jobs.hourly_meter(v.numeric_readings(spark, sf))


@query("q_hourly_filled")
def q_hourly_filled(spark, sf):
    return jobs.hourly_filled(v.numeric_readings(spark, sf, START), START)


@query("q_missing_dates")
def q_missing_dates(spark, sf):
    return jobs.missing_dates(v.numeric_readings(spark, sf, START), START)


@query("q_daily_consumption")
def q_daily_consumption(spark, sf):
    return jobs.daily_consumption(
        v.meter_hourly(spark, sf), v.binding_master(spark, sf), v.spaces(spark, sf), _run_ts()
    )


@query("q_booking_hours")
def q_booking_hours(spark, sf):
    return _hours(spark, sf)


@query("q_consumption_target")
def q_consumption_target(spark, sf):
    return jobs.consumption_target(
        *_booking_inputs(spark, sf), v.space_hourly(spark, sf, SHIFT_DAYS), BOOKING_AS_OF, _run_ts()
    )


@query("q_history_backfill")
def q_history_backfill(spark, sf):
    folder = new_folder(spark, "history")
    rows = jobs.history_backfill(_responses(spark, sf)).withColumn("date_key", F.to_date("ts"))
    writers.append(rows, folder, partition_by=["date_key"])
    return readers.scan(spark, path=folder).select(*READING)


@query("q_wide_export")
def q_wide_export(spark, sf):
    folder = new_folder(spark, "wide")
    export = jobs.wide_day_export(v.wide_readings(spark, sf), "watermeter", WIDE_DAY)
    writers.csv_export(export, folder)
    return spark.read.schema(export.schema).csv(folder)
