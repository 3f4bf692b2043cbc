"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from wattline.operators import enrich, gapfill
from wattline.operators.lookup import lookup_join
from wattline.plans import jobs
from wattline.sources import readers
from wattline.sources import sample_views as v

QUERIES = spark_entry.QUERIES
# Queries that write and read back, or run a stream, while they are built.
EAGER = {
    "stream_read_json", "registry_scan", "dated_table_scan", "sink_append", "upsert_latest",
    "csv_export", "registry_upsert", "stream_hourly_meter", "stream_minute_camera",
    "stream_minute_co2", "stream_carry_forward", "stream_ingest", "stream_ingest_cold",
    "fill_incremental_load", "q_history_backfill", "q_wide_export",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER))
def test_no_python_and_no_cross_join(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        if word == "SinglePartition" and key in ("range_scan_count", "table_count", "null_predicates"):
            continue
        assert word not in text, word


def pushed(text: str) -> str:
    return " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text))


def test_time_range_reaches_the_scan(spark, sf):
    filters = pushed(plan(QUERIES["range_scan_count"](spark, sf)))
    assert "GreaterThanOrEqual(ts,2024-01-14T12:00)" in filters
    assert "LessThan(ts,2024-01-15T12:00)" in filters


@pytest.mark.parametrize("key", ["q_hourly_filled", "q_missing_dates"])
def test_start_reaches_the_scan(spark, sf, key):
    assert pushed(plan(QUERIES[key](spark, sf))).count("GreaterThanOrEqual(ts,2020-02-15T00:00)") == 2


def test_booking_dates_reach_the_scan(spark, sf):
    assert "LessThan(o_orderdate,1998-05-31T00:00)" in pushed(plan(QUERIES["booking_filter"](spark, sf)))
    assert "GreaterThanOrEqual(l_shipdate,1998-05-30T00:00)" in pushed(
        plan(QUERIES["extension_filter"](spark, sf))
    )


def test_only_needed_columns_are_read(spark, sf):
    text = plan(QUERIES["q_hourly_meter"](spark, sf))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text


def test_readings_are_not_shuffled_by_a_fill(spark, sf):
    """The readings branch has no exchange; the other one aggregates by hour before it shuffles."""
    text = plan(QUERIES["q_hourly_filled"](spark, sf))
    readings, added = text.split("+- Union", 1)[1].split("\n   +- ", 1)
    assert "Exchange" not in readings
    below = added[added.rindex("Exchange") :]
    assert "partial_max" in below


def test_daily_consumption_is_a_hash_aggregate(spark, sf):
    assert "SortAggregate" not in plan(QUERIES["daily_consumption"](spark, sf))
    assert "SortAggregate" not in plan(QUERIES["minute_camera_sum"](spark, sf))


def test_small_lookups_are_broadcast_and_facts_stay_in_place(spark, sf):
    text = plan(QUERIES["q_ingest_route"](spark, sf))
    assert text.count("BroadcastHashJoin") == 1
    facts = text.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "Exchange" not in facts


def test_large_lookups_repeat_nothing(spark, sf):
    facts, dim = v.readings(spark, sf), v.registry(spark, sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup_join(facts, dim, ["space_id", "zone_device_id", "zone_device_control_id"], max_bytes=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text
    assert "SortMergeJoin" in text
    assert "Generate" not in text


def test_messages_are_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    parsed = raw.select(readers.parse_message(F.col("value")).alias("data"))
    assert plan(enrich.live(enrich.flatten(parsed))).count("from_json") == 1


def test_gap_window_runs_over_hours(spark, sf):
    text = plan(gapfill.gaps_after(v.numeric_readings(spark, sf)))
    window = text[text.index("Window [") :]
    assert "_hour" in window.split("\n")[0]
    assert "SortAggregate" in window


def test_day_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date_key")).write.partitionBy(
        "date_key"
    ).parquet(path)
    from datetime import date

    df = readers.dated_scan(spark, path, date(2024, 1, 5))
    assert [r["id"] for r in df.collect()] == [3]
    assert re.search(r"PartitionFilters: \[[^\]]*date_key", plan(df))


def test_day_range_prunes_date_partitions(spark, sf, tmp_path):
    path = str(tmp_path / "hourly")
    dated = v.meter_hourly(spark, sf).withColumn("date_key", F.to_date("date_time_key"))
    dated.write.partitionBy("date_key").parquet(path)
    stored = spark.read.parquet(path)
    picked = jobs.day_readings(stored, "2024-01-15", 2, date_column="date_key")
    assert sorted(map(tuple, picked.collect())) == sorted(
        map(tuple, jobs.day_readings(stored, "2024-01-15", 2).collect())
    )
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(picked)).group(1)
    assert "date_key" in partition_filters and ">= 2024-01-13" in partition_filters
    assert "<= 2024-01-15" in partition_filters


def booking_inputs(spark, sf):
    return (v.bookings(spark, sf), v.booking_history(spark, sf), v.extensions(spark, sf), v.users(spark, sf), v.spaces(spark, sf))


def test_target_and_wide_export_prune_date_partitions(spark, sf, tmp_path):
    hourly = v.space_hourly(spark, sf, 9346).withColumn("date_key", F.to_date("date_time_key"))
    hourly.write.partitionBy("date_key").parquet(str(tmp_path / "hourly"))
    v.wide_readings(spark, sf).write.partitionBy("date_key").parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "hourly"))
    whole, dated = (
        jobs.consumption_target(
            *booking_inputs(spark, sf), stored, "1998-06-30", F.lit("2024-02-01").cast("timestamp"), date_column=name
        )
        for name in (None, "date_key")
    )
    assert sorted(map(str, dated.collect())) == sorted(map(str, whole.collect()))
    assert "date_key" in " ".join(re.findall(r"PartitionFilters: \[(.*?)\]", plan(dated)))
    export = jobs.wide_day_export(spark.read.parquet(str(tmp_path / "wide")), "watermeter", "2024-01-05")
    assert re.search(r"PartitionFilters: \[[^\]]*date_key#\d+ = 2024-01-05", plan(export))
    assert export.count() == QUERIES["wide_export"](spark, sf).count() > 0


def test_parts_are_counted_in_one_scan_of_the_readings(spark, sf):
    """One scan of the readings and one for each of the three device tables they are joined with."""
    assert plan(QUERIES["null_predicates"](spark, sf)).count("FileScan parquet") == 4


def test_booking_job_prunes_large_tables_by_semi_join(spark, sf):
    inputs = booking_inputs(spark, sf)
    text = plan(jobs.booking_hours(*inputs, "1998-06-30"))
    assert text.count("LeftSemi") == 3


def test_target_keeps_bookings_without_readings(spark, sf):
    """A null device type holds the hours without readings; without any readings all bookings stay."""
    readings = v.space_hourly(spark, sf, 9346)
    created = F.lit("2024-02-01").cast("timestamp")
    job = lambda rows: jobs.consumption_target(*booking_inputs(spark, sf), rows, "1998-06-30", created)
    whole, none = job(readings).collect(), job(readings.limit(0)).collect()
    bookings = {(r["order_id"], r["space_id"]) for r in none}
    assert bookings and {(r["order_id"], r["space_id"]) for r in whole} == bookings
    assert all(r["device_type"] is None and r["consumption"] is None and r["zone_device_id"] is None for r in none)
    assert all(r["zone_device_code"] == f"dev-{r['zone_device_id']}" for r in whole if r["device_type"])
