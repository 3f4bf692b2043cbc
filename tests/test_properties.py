"""Random series against brute force in plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import gapfill, reduce

HOUR = timedelta(hours=1)
START = datetime(2024, 1, 1)

# Seconds from the start, value, flag; ties in time and long silences are likely.
point = st.tuples(
    st.one_of(st.integers(0, 12 * 3600), st.sampled_from([0, 3600, 7200, 7201, 36000, 86400])),
    st.integers(0, 5),
    st.booleans(),
)
devices = st.lists(st.lists(point, min_size=1, max_size=12), min_size=1, max_size=8)
slow = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def frame(spark, series):
    rows = [
        (1, d, d, START + timedelta(seconds=s), on, False, float(v))
        for d, points in enumerate(series)
        for s, v, on in points
    ]
    return spark.createDataFrame(rows, schemas.HISTORY_READING).repartition(5)


def ordered(points):
    return sorted((START + timedelta(seconds=s), float(v), on) for s, v, on in points)


def bag(df, time="ts"):
    return Counter((r["zone_device_id"], r[time], r["value"], r["is_online"]) for r in df.collect())


@slow
@given(devices)
def test_fill_between(spark, series):
    expected = Counter()
    for d, points in enumerate(series):
        previous = None
        for t, v, on in ordered(points):
            if previous is not None:
                at = previous[0] + HOUR
                while at < t:
                    expected[(d, at, min(previous[1], v), on)] += 1
                    at += HOUR
            expected[(d, t, v, on)] += 1
            previous = (t, v)
    got = gapfill.fill_between(frame(spark, series))
    assert bag(got) == expected


@slow
@given(devices)
def test_fill_between_leaves_no_gap(spark, series):
    times = defaultdict(list)
    for r in gapfill.fill_between(frame(spark, series)).collect():
        times[r["zone_device_id"]].append(r["ts"])
    for seen in times.values():
        seen.sort()
        assert all(b - a <= HOUR for a, b in zip(seen, seen[1:]))


@slow
@given(devices)
def test_fill_forward(spark, series):
    expected = Counter()
    for d, points in enumerate(series):
        rows = ordered(points)
        for (t, v, on), following in zip(rows, [*rows[1:], None]):
            expected[(d, t, v, on)] += 1
            if following is not None:
                for k in range(1, (following[0] - t) // HOUR):
                    expected[(d, t + k * HOUR, v, on)] += 1
    assert bag(gapfill.fill_forward(frame(spark, series))) == expected


@slow
@given(devices, st.integers(1, 11))
def test_two_loads_fill_like_one(spark, series, cut):
    df = frame(spark, series)
    at = F.lit(START + timedelta(hours=cut))
    nothing = df.limit(0).select(*schemas.TRIPLE, "ts", F.col("value").cast("string"))
    rows1, state = gapfill.fill_incremental(df.filter(F.col("ts") < at), nothing)
    rows2, _ = gapfill.fill_incremental(df.filter(F.col("ts") >= at), state)
    assert bag(rows1.unionByName(rows2)) == bag(gapfill.fill_between(df))


@slow
@given(devices)
def test_daily_consumption(spark, series):
    expected = {}
    for d, points in enumerate(series):
        days = defaultdict(list)
        for t, v, on in ordered(points):
            after_cut = (t.hour, t.minute, t.second) > (11, 0, 0)
            days[t.date() + timedelta(days=after_cut)].append((v, on))
        for day, rows in days.items():
            expected[(d, day)] = (rows[-1][0] - rows[0][0], rows[-1][0], rows[-1][1])
    got = reduce.daily_consumption(frame(spark, series), "ts", unique_times=False)
    assert {
        (r["zone_device_id"], r["date_key"]): (r["consumption"], r["value"], r["is_online"])
        for r in got.collect()
    } == expected


@slow
@given(devices)
def test_hourly_max(spark, series):
    expected = {}
    for d, points in enumerate(series):
        for t, v, on in ordered(points):
            key = (d, t.replace(minute=0, second=0))
            expected[key] = max(expected.get(key, (v, t, on)), (v, t, on))
    got = {
        (r["zone_device_id"], r["date_time_key"]): (r["value"], r["is_online"])
        for r in reduce.hourly_max(frame(spark, series)).collect()
    }
    assert got == {k: (v, on) for k, (v, _, on) in expected.items()}
