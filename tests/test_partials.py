"""Running totals, mergeable daily records, map sums and expiry."""

from __future__ import annotations

import itertools
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wattline.operators import bookings as bk
from wattline.operators import reduce, targets, totals
from wattline.plans import jobs
from wattline.sources import readers, writers

PERIOD = bk.Period("2024-03-01", days=70)  # two bitmap words


def booked(spark, rows):
    """Booking windows from (order, space, extension positions)."""
    bits = lambda on, w: sum(1 << p - w * bk.bits_per_word() for p in on if 0 <= p - w * bk.bits_per_word() < bk.bits_per_word())
    data = [(o, s, *(bits(on, w) for w in PERIOD.words)) for o, s, on in rows]
    schema = "order_id long, space_id long, " + ", ".join(f"days_{w} long" for w in PERIOD.words)
    return spark.createDataFrame(data, schema).withColumns(
        {"last_month_date": PERIOD.first, "current_date": PERIOD.last}
    )


def hourly(spark):
    rng = random.Random(4)
    first = datetime(2023, 12, 21, 13)
    rows = []
    for space, kinds in ((1, ["a", "b"]), (2, ["b", None]), (3, ["c"])):
        for kind in kinds:
            for hour in range(24 * 71):
                if space != 3 and rng.random() < 0.9 or space == 3 and 5 <= hour // 24 < 9:
                    amount = None if rng.random() < 0.1 else rng.randrange(1000) / 4
                    rows.append((space, first + timedelta(hours=hour), kind, amount))
    return spark.createDataFrame(
        rows, "space_id long, date_time_key timestamp, device_type string, accumulate_value double"
    )


def test_running_totals_equal_the_sums_over_every_hour(spark):
    windows = booked(spark, [(1, 1, []), (2, 1, [0, 1, 5, 69, 70]), (2, 2, [0, 1, 5, 69, 70]), (3, 3, [4, 5, 6]),
                             (4, 9, [3]), (5, 2, list(range(60, 68)))])
    readings = hourly(spark)
    hours = bk.booking_hours(bk.days_of(windows, PERIOD))
    met = targets.hours_with_readings(hours, readings)
    want = sorted(map(tuple, targets.period_sums(targets.day_sums(met)).collect()), key=repr)
    got = totals.period_sums_from_totals(windows, readings, PERIOD)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert totals.period_sums_from_totals(windows, readings.limit(0), PERIOD).filter("device_type is not null").isEmpty()


def test_no_hour_is_generated(spark, sf):
    from wattline.plans import catalog

    plan = catalog.QUERIES["target_period_totals"](spark, sf)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "explode" not in plan.lower()


def test_daily_records_merge_in_any_order(spark, tmp_path):
    rng = random.Random(2)
    start = datetime(2024, 1, 1)
    rows = [(1, d, d, start + timedelta(hours=h), True, False, float(h * d)) for d in (1, 2) for h in range(60) if rng.random() < 0.8]
    schema = "space_id long, zone_device_id long, zone_device_control_id long, date_time_key timestamp, is_online boolean, is_scenario boolean, value double"
    whole = spark.createDataFrame(rows, schema)
    parts = [whole.filter(F.hour("date_time_key") % 3 == k) for k in range(3)]
    want = sorted(map(tuple, reduce.daily_consumption(whole).collect()))
    for i, order in enumerate(itertools.islice(itertools.permutations(range(3)), 0, 6, 2)):
        path = f"{tmp_path}/{i}"
        for k in (*order, order[0]):
            jobs.load_daily(spark, parts[k], path)
        assert sorted(map(tuple, reduce.consumption_of(readers.scan(spark, path=path)).collect())) == want
    # A load reads and replaces the days that it touches, and no other.
    files = lambda: {r[0] for r in readers.scan(spark, path=path).select(F.input_file_name()).distinct().collect()}
    before = files()
    jobs.load_daily(spark, whole.filter("date_time_key = '2024-01-01 05:00:00'"), path)
    changed = before ^ files()
    assert changed and all("date_key=2024-01-01" in f for f in changed)


def test_maps_are_summed_over_groups(spark):
    rows = [(1, {"a": 1, "b": 2}), (1, {"a": 5}), (1, None), (2, None), (2, {}), (3, {"x": None, "y": 1}), (None, {"z": 4})]
    df = spark.createDataFrame(rows, "k int, m map<string,bigint>")
    found = {r.k: r.m for r in reduce.map_sums(df, ["k"], "m").collect()}
    assert found == {1: {"a": 6, "b": 2}, 2: {}, 3: {"x": None, "y": 1}, None: {"z": 4}}


def test_expired_dates_are_removed_once(spark, tmp_path):
    path = f"{tmp_path}/facts"
    rows = spark.range(40).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date_key"))
    writers.append(rows, path, partition_by=["date_key"])
    gone = writers.expire_partitions(spark, path, "2024-02-01 12:00:00", seconds=20 * 86400)
    assert gone == [f"2024-01-{d:02d}" for d in range(1, 12)]
    assert readers.scan(spark, path=path).count() == 29
    assert writers.expire_partitions(spark, path, "2024-02-01 12:00:00", seconds=20 * 86400) == []
    assert spark.read.json(f"{path}/_expired").count() == 11


def test_expiry_that_was_cut_short_is_finished(spark, tmp_path):
    path = f"{tmp_path}/facts"
    days = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    writers.append(spark.range(5).select("id", days.alias("date_key")), path, partition_by=["date_key"])
    spark.createDataFrame([("2024-01-03", "x")], "date_key string, as_of string").write.json(f"{path}/_expired")
    assert "2024-01-03" in writers.expire_partitions(spark, path, "2024-01-10", seconds=6 * 86400)
    assert sorted(str(r[0]) for r in readers.scan(spark, path=path).select("date_key").collect()) == ["2024-01-04", "2024-01-05"]
