"""Streams: equal to their batch twins, restartable, late rows dropped, batches idempotent."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import enrich, gapfill, reduce
from wattline.sources import readers, registry
from wattline.streaming import carry, corrections, ingest, jobs, run, windows

START = datetime(2024, 1, 1)


def rows(*points, device=1):
    """(minutes from the start, value) as readings."""
    return [
        (1, device, device, START + timedelta(minutes=m), True, False, float(v)) for m, v in points
    ]


def feed(spark, path, data):
    spark.createDataFrame(data, schemas.HISTORY_READING).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema(schemas.HISTORY_READING).parquet(path)


def drive(spark, build, folder, *loads):
    """Append each load and run the stream to its end, from the same checkpoint."""
    path = f"{folder}/in"
    for load in loads:
        feed(spark, path, load)
        query = run.start_append(
            build(source(spark, path)), f"{folder}/out", f"{folder}/checkpoint", trigger={"availableNow": True}
        )
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_hourly_windows_survive_a_restart_and_drop_late_rows(spark, tmp_path):
    first = rows((5, 3), (50, 4), (70, 1), (200, 2))
    late_and_new = rows((6, 99), (210, 9), (600, 1))
    got = drive(spark, windows.hourly_meter, str(tmp_path), first, late_and_new)
    assert {(r["date_time_key"].hour, r["value"]) for r in got.collect()} == {(0, 4.0), (1, 1.0), (3, 9.0)}
    kept = spark.createDataFrame([*first, *late_and_new[1:]], schemas.HISTORY_READING)
    twin = reduce.hourly_max(kept).filter(F.col("date_time_key") < START + timedelta(hours=9))
    assert sorted(map(tuple, got.drop("closed_at").collect())) == sorted(map(tuple, twin.collect()))


def test_camera_minutes(spark, tmp_path):
    def build(stream):
        return windows.minute_camera(stream.withColumn("value", F.col("value").cast("int")))

    got = drive(spark, build, str(tmp_path), rows((0, 1), (0.5, 2), (1, 4), (60, 1)))
    assert {(r["ts"].minute, r["value"]) for r in got.collect()} == {(0, 3), (1, 4)}


def test_messages_are_typed(spark):
    texts = [
        '{"space_id":1,"zone_device_id":2,"zone_device_control_id":3,"ts":"2024-01-01 00:00:05","is_online":true,"value":1.5,"is_scenario":false}',
        "not json",
        '{"space_id":1}',
    ]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    found = windows.meter_messages(raw).collect()
    assert [(r["zone_device_id"], r["ts"], r["value"]) for r in found] == [(2, datetime(2024, 1, 1, 0, 0, 5), 1.5)]
    assert windows.camera_messages(raw.filter("value like '{\"space_id\":1}'")).count() == 0


@pytest.mark.parametrize("max_steps", [None, 2])
def test_carry_equals_its_batch_twin_over_restarts(spark, tmp_path, max_steps):
    carry.use_rocksdb(spark)

    def build(stream):
        return carry.carry_forward(windows.hourly_meter(stream), "date_time_key", 3600, max_steps)

    loads = [
        [*rows((5, 3), (70, 4), (200, 5)), *rows((10, 1), device=2)],
        [*rows((610, 6)), *rows((400, 2), device=2)],
        [*rows((1500, 7))],
    ]
    got = drive(spark, build, str(tmp_path), *loads)
    everything = spark.createDataFrame([r for load in loads for r in load], schemas.HISTORY_READING)
    # The last row moves the watermark to 24:50, so the hour from 23:00 is the last closed one.
    until = START + timedelta(hours=23)
    hourly = reduce.hourly_max(everything).filter(F.col("date_time_key") <= until)
    twin = gapfill.carry_forward(hourly, F.lit(until), hours=1, max_steps=max_steps)
    columns = [*schemas.TRIPLE, "date_time_key", "value", "carried"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(
        map(tuple, twin.select(*columns).collect())
    )


@pytest.mark.parametrize(
    ("job", "expected"),
    [
        (jobs.hourly_meter, {("00:00", 3.0, False), ("01:00", 3.0, True), ("02:00", 4.0, False)}),
        (jobs.minute_camera, {("00:05", 2), ("00:50", 3), ("02:10", 4)}),
        (
            jobs.minute_co2,
            {
                # The last reading moves the watermark to 03:10.
                (f"{m // 60:02}:{m % 60:02}", 2.0 if m < 50 else 3.0 if m < 130 else 4.0, m not in (5, 50, 130))
                for m in range(5, 190)
            },
        ),
    ],
)
def test_jobs_from_messages_to_a_dated_table(spark, tmp_path, job, expected):
    readings = spark.createDataFrame(rows((5, 2), (50, 3), (130, 4), (200, 1)), schemas.HISTORY_READING)
    number = F.col("value").cast("int") if job is jobs.minute_camera else F.col("value")
    message = F.struct(*schemas.TRIPLE, F.col("ts").cast("string").alias("ts"), number.alias("value"), *schemas.FLAGS)
    readings.select(F.to_json(message).alias("value")).write.text(f"{tmp_path}/in")
    raw = readers.read_messages(spark, "text", {"path": f"{tmp_path}/in"})
    query = job(raw, f"{tmp_path}/out", f"{tmp_path}/cp", trigger={"availableNow": True})
    query.awaitTermination()
    table = spark.read.parquet(f"{tmp_path}/out")
    time = F.date_format("date_time_key" if "date_time_key" in table.columns else "ts", "HH:mm")
    carried = ["carried"] if "carried" in table.columns else []
    assert {tuple(r) for r in table.select(time, "value", *carried).collect()} == expected
    assert table.select("date_key").distinct().count() == 1


TRIPLE_DDL = "space_id bigint, zone_device_id bigint, zone_device_control_id bigint"


def test_a_repeated_ingest_batch_changes_nothing(spark, tmp_path):
    def table(data, ddl):
        return lambda s: s.createDataFrame(data, f"{TRIPLE_DDL}{ddl}")

    tables = ingest.Tables(
        registry=table([(1, 1, 1, "elemeter", 1020)], ", device_type string, zone_device_control_tag int"),
        invalid=table([(1, 3, 3)], ""),
        master=table([(1, 2, 2, "camera", 1010)], ", device_type_c string, zone_device_control_tag int"),
    )
    batch = spark.createDataFrame(
        [(1, d, d, START, True, "7", False) for d in (1, 2, 3, 4)],
        f"{TRIPLE_DDL}, ts timestamp, is_online boolean, value string, is_scenario boolean",
    )
    targets = ingest.Targets(
        f"{tmp_path}/facts", f"{tmp_path}/devices", topic_fmt="json", topic_options={"path": f"{tmp_path}/sent"}
    )
    for sent in (2, 4):
        ingest.write_batch(batch, 5, tables, targets)
        # Once per run of the batch, and only what is routed.
        assert spark.read.json(f"{tmp_path}/sent").count() == sent
    topics = {r["topic"] for r in spark.read.json(f"{tmp_path}/sent").collect()}
    assert topics == {enrich.TOPICS["meter"], enrich.TOPICS["camera"]}
    facts = spark.read.parquet(targets.facts)
    assert sorted((r["zone_device_id"], r["kind"], r["batch_id"]) for r in facts.collect()) == [
        (1, "meter", 5), (2, "camera", 5),
    ]
    devices = spark.read.parquet(targets.registry)
    assert sorted((r["table"], r["_id"]) for r in devices.collect()) == [
        ("DEVICE_CAMERA", "1-2-2"), (enrich.INVALID_TABLE, "1-4-4"),
    ]


def test_late_readings_correct_stored_hours_over_restarts(spark, tmp_path):
    loads = [rows((5, 3), (50, 4), (200, 2)), rows((6, 99), (210, 9), (600, 1)), rows((205, 9), (7, 98), (1500, 5)),
             rows((8, 97), device=2)]
    path, root = f"{tmp_path}/in", f"{tmp_path}/hours"
    for load in loads:
        feed(spark, path, load)
        started = corrections.start_corrected_hours(
            source(spark, path), root, f"{tmp_path}/checkpoint", {"availableNow": True}, block_hours=6
        )
        started.awaitTermination()
    everything = spark.createDataFrame([r for load in loads for r in load], schemas.HISTORY_READING)
    want = sorted(map(tuple, reduce.hourly_max(everything).collect()))
    assert sorted(map(tuple, corrections.corrected_hours(spark, root).collect())) == want
    closed = corrections.corrected_hours(spark, root, closed_only=True)
    assert sorted(map(tuple, closed.collect())) == [r for r in want if r[-1] < START + timedelta(hours=24)]
    late = {r.batch_id: r.late_rows for r in spark.read.parquet(f"{root}/marks").collect()}
    assert late == {0: 0, 1: 1, 2: 2, 3: 1}
    # A batch that is run again changes nothing but what it replaces.
    corrections.write_batch(spark.createDataFrame(loads[3], schemas.HISTORY_READING), 3, root, block_hours=6)
    assert sorted(map(tuple, corrections.corrected_hours(spark, root).collect())) == want


@pytest.mark.parametrize("max_steps", [None, 3])
def test_a_stream_started_from_a_table_equals_one_that_never_stopped(spark, tmp_path, max_steps):
    carry.use_rocksdb(spark)
    first = [*rows((5, 3), (70, 4), (400, 1)), *rows((10, 1), device=2)]
    second = [*rows((900, 6)), *rows((1000, 2), device=3), *rows((1500, 7))]

    def build(initial=None):
        return lambda stream: carry.carry_forward(
            windows.hourly_meter(stream), "date_time_key", 3600, max_steps, initial
        )

    want = drive(spark, build(), f"{tmp_path}/one", first, second)
    before = drive(spark, build(), f"{tmp_path}/two", first)
    # The hour that the first stream had not closed comes again.
    opened = [r for r in first if r[3] >= START + timedelta(hours=6)]
    initial = carry.last_states(before, "date_time_key")
    after = drive(spark, build(initial), f"{tmp_path}/three", [*opened, *second])
    assert sorted(map(tuple, before.unionByName(after).collect())) == sorted(map(tuple, want.collect()))


def test_runs_hold_the_same_minutes(spark):
    runs = [(1, 1, 1, START + timedelta(minutes=a), START + timedelta(minutes=b), v, True, False, a != b)
            for a, b, v in ((3, 3, 1.0), (4, 130, 1.0), (131, 131, 5.0), (132, 180, 5.0))]
    df = spark.createDataFrame(runs, "space_id long, zone_device_id long, zone_device_control_id long, ts timestamp, until timestamp, value double, is_online boolean, is_scenario boolean, carried boolean")
    minutes = carry.every_period(df, "ts", 60)
    assert minutes.count() == 178
    want = minutes.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("carried").alias("c"), F.max("value").alias("v")
    )
    got = carry.hours_of_runs(df).select("hour", "minutes", "carried", "most")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    state = carry.last_states(df, "ts").first()
    assert (state.value, state.reached - state["at"]) == (5.0, 49 * 60_000_000)


def test_registry_folds_units_and_lists_few_files(spark, tmp_path):
    root = f"{tmp_path}/devices"
    schema = "table string, key string, space_id long, zone_device_id long, zone_device_control_id long, zone_device_control_tag int, device_type string"
    for unit in range(50):
        # A new device each time, and one that every unit writes anew.
        data = [("DEVICE_A", f"1-{unit}-1", 1, unit, 1, 1020, "elemeter"), ("DEVICE_B", "1-2-3", 1, 2, 3, unit, "camera")]
        registry.write_unit(spark, spark.createDataFrame(data, schema).coalesce(1), root, str(unit))
        if unit % 10 == 9:
            registry.compact(spark, root)
    found = registry.devices(spark, root)
    assert found.count() == 51 and found.filter("_id = '1-2-3'").first().zone_device_control_tag == 49
    assert registry.devices(spark, root, "DEVICE_A").count() == 50
    number = registry.newest_snapshot(spark, root)
    files = spark.read.option("basePath", root).parquet(f"{root}/snapshot={number}").inputFiles()
    assert number == 5 and len(files) <= 4
    # A unit that comes again after a compaction, and a snapshot that was cut short.
    registry.write_unit(spark, spark.createDataFrame(data, schema), root, "49")
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{root}/snapshot={number + 1}")
    assert registry.devices(spark, root).count() == 51
    assert registry.compact(spark, root) == number + 1 and registry.devices(spark, root).count() == 51


def test_every_message_is_routed_or_refused(spark, tmp_path):
    good = '{"spaceId":1,"zoneDeviceId":"2","zoneDeviceControlId":3,"ts":"2024-01-01T00:00:05Z","isOnline":true,"value":7,"isScenario":"false"}'
    texts = [good, "Exception", '{"spaceId":1}', "[]", "", '{"spaceId":"x","zoneDeviceId":2,"zoneDeviceControlId":3,"ts":"2024-01-01 00:00:00"}', None, "null"]
    parsed = readers.parse_ragged(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [r.refused for r in parsed if r.data is None] == [t or "" for t in texts[1:]]
    assert [tuple(r.data) for r in parsed if r.refused is None] == [(1, 2, 3, datetime(2024, 1, 1, 0, 0, 5), True, "7", False)]


def test_counts_come_from_file_statistics(spark, sf):
    counted = readers.row_count(spark, f"{sf}/events.parquet")
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().toString()
    assert counted.first().rows == spark.read.parquet(f"{sf}/events.parquet").count()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
