"""Booking hours met by readings: the sums, and how the work is laid out."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.operators import bookings as bk
from wattline.operators import targets
from wattline.plans import catalog, jobs

FIRST = datetime(1998, 5, 30, 13)


@pytest.fixture
def tables(spark, tmp_path):
    """One booking of the whole window, and three hours read by three devices of its space."""

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    at = FIRST + timedelta(days=catalog.SHIFT_DAYS)
    events = [(h * 10 + u, at + timedelta(hours=h), u, "view", u / 4 + h) for h in (0, 1, 24) for u in (0, 100, 50)]
    write("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    write("orders", [(118, 0, datetime(1998, 5, 1), "2-HIGH", "O")],
          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string")
    write("lineitem", [], "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double, l_returnflag string")
    write("customer", [(0, "one")], "c_custkey long, c_name string")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["target_day_sum", "target_period_sum"])
def test_an_hour_meets_one_row_per_device_type(spark, tables, monkeypatch, name):
    """Devices 0 and 100 are of one type in one space: their readings are summed before the join."""
    seen = []
    join = targets.hours_with_readings

    def spied(hours, readings, *more):
        seen.append(readings)
        return join(hours, readings, *more)

    monkeypatch.setattr(targets, "hours_with_readings", spied)
    found = sorted(map(tuple, catalog.QUERIES[name](spark, tables).collect()), key=repr)
    (readings,) = seen
    assert readings.groupBy("space_id", "date_time_key", "device_type").count().filter("count > 1").isEmpty()
    kinds = {}
    for day, kind, amount in ((0, "elemeter", 52.0), (0, "camera", 26.0), (1, "elemeter", 73.0), (1, "camera", 36.5)):
        kinds.setdefault(kind, {})[day] = amount
    if name == "target_period_sum":
        want = [(118, k, sum(days.values()), len(days)) for k, days in kinds.items()] + [(118, None, None, 31)]
    else:
        dates = [(FIRST + timedelta(days=d)).date() for d in range(31)]
        want = [(dates[d], 118, False, k, x) for k, days in kinds.items() for d, x in days.items()]
        want += [(d, 118, False, None, None) for d in dates]
    assert found == sorted(want, key=repr)


def test_sums_of_an_hour_give_the_sums_of_its_readings(spark):
    """Readings and sums alike, with null types, amounts and spaces, and with the sums broadcast."""
    rng = random.Random(3)
    rows = [
        (rng.choice([1, 2, 3, None]), FIRST + timedelta(hours=rng.randrange(60)), rng.choice(["a", "b", None]),
         rng.choice([None, 0.1, 0.2, -7.25, rng.randrange(1000) / 8]))
        for _ in range(600)
    ]
    readings = spark.createDataFrame(rows, "space_id long, date_time_key timestamp, device_type string, accumulate_value double")
    days = [(o, s, (FIRST + timedelta(days=d)).date(), d == 1) for o, s in ((1, 1), (1, 2), (2, 9), (3, 3), (4, None)) for d in range(3)]
    hours = bk.booking_hours(spark.createDataFrame(days, "order_id long, space_id long, date date, on_rerent boolean"))
    rows_of = lambda met: sorted(map(tuple, targets.day_sums(met).collect()), key=repr)
    want = rows_of(targets.hours_with_readings(hours, readings))
    sums = targets.hourly_sums(readings)
    assert rows_of(targets.hours_with_readings(hours, sums)) == want
    assert rows_of(targets.hours_with_readings(hours, sums, 1 << 20)) == want


def test_hours_are_generated_in_all_partitions(spark):
    """Few windows make many hours; no single task may make them all."""
    stay = datetime(1998, 5, 1), datetime(1998, 9, 1)
    bookings = spark.createDataFrame(
        [(i, f"B{i}", i % 5, i % 7, "tenant", "active", *stay) for i in range(200)],
        "id long, order_number string, user_id long, space_id long, order_type_c string, status_c string,"
        " check_in_date timestamp, check_out_date timestamp",
    )
    empty = lambda schema: spark.createDataFrame([], schema)
    hours = jobs.booking_hours(
        bookings,
        empty("order_id long, space_id string"),
        empty("id long, order_id long, start_date timestamp, end_date timestamp, created_at timestamp, status_c string"),
        empty("id long, display_name string"),
        empty("id long, type_c string, code string"),
        "1998-06-30",
    )
    made = hours.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 200 * 31 * 24
    assert len(made) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_readings_in_small_files_are_not_broadcast(spark, tables):
    df = catalog.QUERIES["hours_with_readings"](spark, tables)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[space_id#\d+L, date_time_key#\d+\]", text)
    assert df.filter("zone_device_id is not null").count() == 9 and df.count() == 31 * 24 + 6


def test_times_are_not_cast_for_every_pair(spark, tables):
    """What is cast after the join is cast for each of its rows."""
    df = catalog.QUERIES["hours_with_readings"](spark, tables)
    above, join, _ = df._jdf.queryExecution().executedPlan().toString().partition("SortMergeJoin")
    assert join and "cast(" not in above
    assert dict(df.dtypes)["date_time_key"] == "timestamp_ntz"
    read = df.filter("zone_device_id is not null").select("date_time_key").distinct().collect()
    assert sorted(r[0] for r in read) == [FIRST + timedelta(hours=h) for h in (0, 1, 24)]


def test_hours_meet_readings_in_several_tasks_for_each_core(spark):
    """Little is shuffled and much comes out, also when the hours are few; null keys meet nothing."""
    at = lambda h: FIRST + timedelta(hours=h)
    hours = [(o, s, at(h)) for o in range(3) for s in (1, 2, 3, None) for h in range(200)] + [(7, 1, None), (7, 1, at(0)), (7, 1, at(0))]
    readings = [(s, at(h), d) for s in (1, 2, None, 9) for h in range(0, 200, 2) for d in (5, 5, 6)] + [(1, None, 8)]
    met = targets.hours_with_readings(
        spark.createDataFrame(hours, "order_id long, space_id long, date_time_key timestamp"),
        spark.createDataFrame(readings, "space_id long, date_time_key timestamp, zone_device_id long"),
    )
    want = []
    for o, s, t in hours:
        found = [d for rs, rt, d in readings if s is not None and t is not None and (rs, rt) == (s, t)]
        want += [(s, t, o, d) for d in found or [None]]
    assert sorted(map(tuple, met.select("space_id", "date_time_key", "order_id", "zone_device_id").collect()), key=repr) == sorted(want, key=repr)
    assert met.select(F.spark_partition_id()).distinct().count() >= 4 * spark.sparkContext.defaultParallelism
