"""Hand-made cases with known results."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions import scalars as sc
from wattline.functions import timecols as tc
from wattline.operators import bookings as bk
from wattline.operators import enrich, gapfill, history, reduce
from wattline.plans import jobs

DAY = "2016-10-01 "
SERIES = [("00:00", 1), ("01:00", 2), ("03:00", 0), ("06:00", 1), ("07:00", 0), ("11:00", 2)]


def reading(ts, value, device=1, online=True, scenario=False):
    return (1, device, device + 100, datetime.fromisoformat(ts), online, scenario, float(value))


def readings(spark, rows):
    return spark.createDataFrame(rows, schemas.HISTORY_READING)


def series(spark):
    return readings(spark, [reading(f"{DAY}{t}:00", v) for t, v in SERIES])


def by_time(df, column="ts"):
    return {row[column].strftime("%H:%M"): row["value"] for row in df.collect()}


@pytest.mark.parametrize("unique", [False, True])
def test_fill_forward_on_the_gap_series(spark, unique):
    filled = by_time(gapfill.fill_forward(series(spark), unique_times=unique))
    assert [filled[f"{h:02d}:00"] for h in range(12)] == [1, 2, 2, 0, 0, 0, 1, 0, 0, 0, 0, 2]


@pytest.mark.parametrize("unique", [False, True])
def test_fill_between_on_the_gap_series(spark, unique):
    added = by_time(gapfill.hours_between_readings(series(spark), unique_times=unique))
    assert added == {h: 0 for h in ["02:00", "04:00", "05:00", "08:00", "09:00", "10:00"]}


def test_fractional_gap_differs_between_the_two_fills(spark):
    df = readings(spark, [reading(f"{DAY}00:00:00", 5), reading(f"{DAY}02:30:00", 9)])
    assert sorted(by_time(gapfill.fill_forward(df))) == ["00:00", "01:00", "02:30"]
    assert sorted(by_time(gapfill.fill_between(df))) == ["00:00", "01:00", "02:00", "02:30"]


def test_gap_of_an_exact_hour_is_not_filled(spark):
    df = readings(spark, [reading(f"{DAY}00:20:00", 5), reading(f"{DAY}01:20:00", 9)])
    assert gapfill.fill_between(df).count() == 2
    assert gapfill.fill_forward(df).count() == 2


def test_fills_keep_devices_apart(spark):
    df = readings(
        spark, [reading(f"{DAY}00:00:00", 1, device=1), reading(f"{DAY}05:00:00", 1, device=2)]
    )
    assert gapfill.fill_between(df).count() == gapfill.fill_forward(df).count() == 2


def test_flags_of_filled_rows(spark):
    df = readings(
        spark, [reading(f"{DAY}00:00:00", 3, online=True), reading(f"{DAY}02:00:00", 7, online=False)]
    )
    later = gapfill.hours_between_readings(df).first()
    assert (later["value"], later["is_online"]) == (3.0, False)
    earlier = gapfill.fill_forward(df).filter(F.hour("ts") == 1).first()
    assert (earlier["value"], earlier["is_online"]) == (3.0, True)


def last_known(spark, rows):
    schema = (
        "space_id bigint, zone_device_id bigint, zone_device_control_id bigint, ts timestamp, value string"
    )
    return spark.createDataFrame(
        [(1, d, d + 100, datetime.fromisoformat(t), v) for d, t, v in rows], schema
    )


def test_incremental_fill_starts_from_the_stored_reading(spark):
    known = last_known(spark, [(1, f"{DAY}00:00:00", "4.0"), (2, f"{DAY}00:00:00", "broken")])
    new = readings(
        spark,
        [reading(f"{DAY}03:00:00", 9, device=d) for d in (1, 2, 3)],
    )
    rows, state = gapfill.fill_incremental(new, known)
    got = sorted((r["zone_device_id"], r["ts"].hour, r["value"]) for r in rows.collect())
    assert got == [(1, 1, 4.0), (1, 2, 4.0), (1, 3, 9.0), (3, 3, 9.0)]
    kept = {r["zone_device_id"]: (r["ts"].hour, r["value"]) for r in state.collect()}
    assert kept == {1: (3, "9.0"), 2: (0, "broken"), 3: (3, "9.0")}


def test_incremental_fill_takes_readings_older_than_the_stored_one(spark):
    known = last_known(spark, [(1, f"{DAY}08:00:00", "4.0")])
    rows, state = gapfill.fill_incremental(readings(spark, [reading(f"{DAY}03:00:00", 9)]), known)
    assert by_time(rows) == {"03:00": 9.0}
    assert [(r["ts"].hour, r["value"]) for r in state.collect()] == [(3, "9.0")]


def test_two_loads_fill_like_one(spark):
    whole = series(spark)
    first, second = whole.filter(F.hour("ts") < 6), whole.filter(F.hour("ts") >= 6)
    rows1, state = gapfill.fill_incremental(first, last_known(spark, []))
    rows2, _ = gapfill.fill_incremental(second, state)
    assert by_time(rows1.unionByName(rows2)) == by_time(gapfill.fill_between(whole))


def test_carry_forward(spark):
    hourly = series(spark).withColumnRenamed("ts", "date_time_key")
    until = F.lit(f"{DAY}13:00:00").cast("timestamp")
    rows = gapfill.carry_forward(hourly, until, hours=1).orderBy("date_time_key").collect()
    assert [r["value"] for r in rows] == [1, 2, 2, 0, 0, 0, 1, 0, 0, 0, 0, 2, 2, 2]
    assert [r["carried"] for r in rows].count(True) == 8
    short = gapfill.carry_forward(hourly, until, hours=1, max_steps=1)
    assert short.filter("carried").count() == 4


def test_maps_merge(spark):
    left = F.create_map(*(F.lit(x) for x in ("a", 1, "b", 2, "c", 3)))
    right = F.create_map(*(F.lit(x) for x in ("a", 3, "c", 2, "d", 1)))
    merged = spark.range(1).select(sc.merge_counts(left, right).alias("m")).first()["m"]
    assert merged == {"a": 4, "b": 2, "c": 5, "d": 1}


@pytest.mark.parametrize(
    ("time", "ending", "starting"),
    [
        ("00:00:00", 9, 8),
        ("10:59:59", 9, 8),
        ("11:00:00", 9, 8),
        ("11:00:00.999", 9, 8),
        ("11:00:01", 10, 8),
        ("12:00:00", 10, 8),
        ("12:00:00.5", 10, 8),
        ("12:00:01", 10, 9),
        ("23:00:00", 10, 9),
    ],
)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_business_days(spark, time, ending, starting, kind):
    ts = F.lit(f"2020-03-09 {time}").cast(kind)
    row = spark.range(1).select(tc.day_ending(ts).alias("e"), tc.day_starting(ts).alias("s")).first()
    assert (row["e"], row["s"]) == (date(2020, 3, ending), date(2020, 3, starting))


def test_hours_of_a_booking_day(spark):
    hours = spark.range(1).select(tc.hours_of_day(F.lit("2020-03-09").cast("date")).alias("h")).first()["h"]
    assert len(hours) == 24
    assert (hours[0], hours[-1]) == (datetime(2020, 3, 9, 13), datetime(2020, 3, 10, 12))


@pytest.mark.parametrize(
    ("start", "end", "repeat", "days"),
    [
        ("2020-01-01", "2020-01-03", False, [1, 2, 3]),
        ("2020-01-01", "2020-01-03", True, [1, 1, 2, 3]),
        ("2020-01-02", "2020-01-02", False, [2]),
        ("2020-01-02", "2020-01-02", True, [2, 2]),
        ("2020-01-03", "2020-01-02", False, []),
        ("2020-01-03", "2020-01-02", True, [3, 2]),
    ],
)
def test_date_lists(spark, start, end, repeat, days):
    a, b = F.lit(start).cast("date"), F.lit(end).cast("date")
    got = spark.range(1).select(tc.dates_between(a, b, repeat).alias("d")).first()["d"]
    assert [d.day for d in got] == days


def test_days_since_anniversary(spark):
    def days(month, day, as_of):
        column = tc.days_since_anniversary(F.lit(month), F.lit(day), F.lit(as_of).cast("date"))
        return spark.range(1).select(column.alias("n")).first()["n"]

    assert days(3, 1, "2020-03-09") == 8
    assert days(12, 31, "2020-03-09") == 69
    assert days(2, 29, "2021-03-09") == 8


def test_numeric_texts(spark):
    texts = ["1", "-2", "+3", " 1", "1.5", "1e3", "a", "", "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", sc.is_int(F.col("t")).alias("i"), sc.is_double(F.col("t")).alias("d")).collect()
    assert [r["t"] for r in rows if r["i"]] == ["1", "-2", "+3"]
    assert [r["t"] for r in rows if not r["d"]] == ["a", ""]


def test_exact_difference(spark):
    row = spark.range(1).select(sc.exact_difference(F.lit(0.3), F.lit(0.1)).alias("x")).first()
    assert row["x"] == 0.2


READS = (
    '{"data":{"reads":['
    + ",".join(
        '{"spaceId":21,"zoneDeviceId":312,"zoneDeviceControlId":794,"isScenario":false,'
        f'"isOnline":true,"value":"15.0","ts":"2019-06-16T{h:02d}:00:00Z"}}'
        for h in (8, 9, 10)
    )
    + "]}}"
)


def test_history_responses(spark):
    texts = [READS, '{"message":"none"}', "Exception", '{"data":{}}', '{"data":{"reads":[]}}']
    rows = history.history_reads(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert sorted(r["ts"] for r in rows) == [datetime(2019, 6, 16, h) for h in (8, 9, 10)]
    assert {(r["space_id"], r["zone_device_id"], r["zone_device_control_id"], r["value"]) for r in rows} == {
        (21, 312, 794, 15.0)
    }


def test_hourly_max_takes_the_latest_on_a_tie(spark):
    df = readings(
        spark,
        [
            reading(f"{DAY}00:10:00", 5, online=True),
            reading(f"{DAY}00:20:00", 5, online=False),
            reading(f"{DAY}00:30:00", 4, online=True),
        ],
    )
    row = reduce.hourly_max(df).first()
    assert (row["value"], row["is_online"]) == (5.0, False)


def test_daily_consumption_of_one_reading_is_zero(spark):
    hourly = series(spark).limit(1).withColumnRenamed("ts", "date_time_key")
    assert reduce.daily_consumption(hourly).first()["consumption"] == 0.0


def test_camera_minute(spark):
    df = spark.createDataFrame(
        [
            (1, datetime(2020, 1, 1, 0, 0, 5), 2, True, False),
            (1, datetime(2020, 1, 1, 0, 0, 50), 3, False, True),
            (1, datetime(2020, 1, 1, 0, 1, 0), 4, True, False),
        ],
        "space_id bigint, ts timestamp, value int, is_online boolean, is_scenario boolean",
    )
    rows = [tuple(r) for r in reduce.minute_camera_sum(df).orderBy("ts").collect()]
    assert rows == [
        (1, 5, False, True, datetime(2020, 1, 1, 0, 0)),
        (1, 4, True, False, datetime(2020, 1, 1, 0, 1)),
    ]


def test_flags_must_be_true_or_false(spark):
    df = spark.createDataFrame(
        [(1, True, False), (2, False, False), (3, True, True), (4, None, False), (5, True, None)],
        "id int, is_online boolean, is_scenario boolean",
    )
    assert [r["id"] for r in enrich.live(df).collect()] == [1]


TRIPLE_DDL = "space_id bigint, zone_device_id bigint, zone_device_control_id bigint"


def test_routes(spark):
    registry = spark.createDataFrame(
        [(1, 1, 1, "elemeter", 1020), (1, 2, 2, "toaster", 1)],
        f"{TRIPLE_DDL}, device_type string, zone_device_control_tag int",
    )
    invalid = spark.createDataFrame([(1, 3, 3)], TRIPLE_DDL)
    master = spark.createDataFrame(
        [(1, 3, 3, "camera", 1010), (1, 4, 4, "camera", 1010), (1, 5, 5, "camera", 1020)],
        f"{TRIPLE_DDL}, device_type_c string, zone_device_control_tag int",
    )
    raw = spark.createDataFrame(
        [(1, d, d, datetime(2020, 1, 1), True, False, "7") for d in (1, 2, 3, 4, 5, 6)],
        f"{TRIPLE_DDL}, ts timestamp, is_online boolean, is_scenario boolean, value string",
    )
    rows = {r["zone_device_id"]: r for r in jobs.ingest(raw, registry, invalid, master).collect()}
    assert {d: (r["route"], r["kind"]) for d, r in rows.items()} == {
        1: ("known", "meter"),
        2: ("known", None),
        3: ("listed_invalid", None),
        4: ("newly_known", "camera"),
        5: ("invalid", None),
        6: ("invalid", None),
    }
    assert (rows[1]["value_double"], rows[4]["value_int"]) == (7.0, 7)
    routed = jobs.ingest(raw, registry, invalid, master)
    written = {(r["table"], r["key"]) for r in enrich.registry_rows(routed).collect()}
    assert written == {("DEVICE_CAMERA", "1-4-4"), ("INVALID_DEVICE", "1-5-5"), ("INVALID_DEVICE", "1-6-6")}
    assert enrich.messages(routed).count() == 2


# -- bookings -----------------------------------------------------------------------------------

PERIOD = bk.Period("1998-06-30")


def booking_tables(spark, extensions, history_spaces=()):
    ts = datetime.fromisoformat
    bookings = spark.createDataFrame(
        [(1, "B1", 10, 3, "tenant", "active", ts("1998-01-01"), ts("1998-12-31"))],
        "id bigint, order_number string, user_id bigint, space_id bigint, order_type_c string, "
        "status_c string, check_in_date timestamp, check_out_date timestamp",
    )
    spaces_of = spark.createDataFrame(
        [(1, s) for s in history_spaces], "order_id bigint, space_id string"
    )
    ext = spark.createDataFrame(
        [(i, 1, ts(a), ts(b), ts(a), "active") for i, (a, b) in enumerate(extensions)],
        "id bigint, order_id bigint, start_date timestamp, end_date timestamp, created_at timestamp, status_c string",
    )
    users = spark.createDataFrame([(10, "Ann")], "id bigint, display_name string")
    spaces = spark.createDataFrame([(3, "R3", "room"), (4, "R4", "room")], "id bigint, code string, type_c string")
    return bookings, spaces_of, ext, users, spaces


@pytest.mark.parametrize(("repeat", "hours"), [(False, 31 * 24), (True, 0)])
def test_extension_of_14_days(spark, repeat, hours):
    tables = booking_tables(spark, [("1998-06-05", "1998-06-18")])
    rows = jobs.booking_hours(*tables, "1998-06-30", repeat_start=repeat)
    assert rows.count() == hours
    if hours:
        assert rows.filter("on_rerent").count() == 14 * 24


def test_extension_rows_count_once_per_history_row(spark):
    tables = booking_tables(spark, [("1998-06-05", "1998-06-11")], ["4", "4"])
    assert jobs.booking_hours(*tables, "1998-06-30").count() == 31 * 24
    tables = booking_tables(spark, [("1998-06-05", "1998-06-12")], ["4", "4"])
    assert jobs.booking_hours(*tables, "1998-06-30").count() == 0


def test_history_space_replaces_the_booked_one(spark):
    rows = jobs.booking_hours(*booking_tables(spark, [], ["", "4"]), "1998-06-30")
    found = {(r["space_id"], r["room"]) for r in rows.select("space_id", "room").distinct().collect()}
    assert found == {(3, "R3"), (4, "R4")}


EXTENSIONS = [
    [("1998-06-05", "1998-06-18"), ("1998-06-10", "1998-06-12")],
    [("1998-05-30", "1998-06-02")],
    [("1998-06-25", "1998-07-20")],
    [("1998-06-07", "1998-06-07")],
    [("1998-05-30", "1998-05-30")],
    [("1998-06-09", "1998-06-05")],
    [("1998-06-09", "1998-05-30")],
    [("1998-06-29", "1998-06-30"), ("1998-05-30", "1998-05-31")],
]


@pytest.mark.parametrize("repeat", [False, True])
@pytest.mark.parametrize("extensions", EXTENSIONS)
@pytest.mark.parametrize("days", [30, 100])
def test_bitmap_equals_the_day_join(spark, extensions, repeat, days):
    """The bitmap and the count agree with lists that are joined day by day."""
    period = bk.Period("1998-06-30", days)
    bookings, history_rows, ext, _, _ = booking_tables(spark, extensions)
    live = bk.live_extensions(ext, period)
    base = bk.with_actual_space(bk.current_bookings(bookings, period), history_rows)
    joined = bk.booking_days(base, repeat).join(bk.extension_days(live, repeat), ["order_id", "date"], "left")
    met = joined.filter("id is not null").select("date").collect()
    expected_days, expected_rows = {r["date"] for r in met}, len(met)

    window = base.join(bk.extension_summary(live, period, repeat), "order_id", "left")
    assert (window.first()["day_rows"] or 0) == expected_rows
    got = bk.days_of(window, period)
    assert {r["date"] for r in got.filter("on_rerent").collect()} == expected_days
    assert got.count() == days + 1

    counted = bk.days_on_extension(bk.booking_days(base, repeat), live, period, repeat)
    total = counted.filter("on_rerent").agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    assert total == expected_rows
