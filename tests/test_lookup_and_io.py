"""Checked joins, sources and sinks."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wattline import workspace
from wattline.operators import lookup
from wattline.operators.reduce import minute_camera_sum
from wattline.plans import jobs
from wattline.schemas import HISTORY_READING
from wattline.sources import readers, writers


@pytest.fixture(scope="module")
def tables(spark):
    """Facts in which one key holds a third of the rows and some rows are exact copies."""
    facts = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 100).alias("x"),
    )
    dim = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("d"), "id").alias("name"))
    return facts, dim


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_every_size_gives_the_plain_join(tables, how):
    facts, dim = tables
    expected = sorted(map(tuple, facts.join(dim, ["k"], how).collect()), key=str)
    for size in (lookup.BROADCAST_BYTES, 1, 0):
        got = lookup.lookup_join(facts, dim, ["k"], how, max_bytes=size)
        assert sorted(map(tuple, got.collect()), key=str) == expected


def test_other_joins_are_refused(tables):
    with pytest.raises(ValueError):
        lookup.lookup_join(*tables, ["k"], "full")


def test_size_is_measured(spark):
    dim = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("text"))
    assert lookup.fits_broadcast(dim, 132_000)
    assert not lookup.fits_broadcast(dim, 131_999)


def test_settled_table_is_read_from_the_checkpoint(spark):
    settled = lookup.settle(spark.range(5).select((F.col("id") * 2).alias("x")))
    assert [r["x"] for r in settled.orderBy("x").collect()] == [0, 2, 4, 6, 8]
    assert "ExistingRDD" in settled._jdf.queryExecution().executedPlan().toString()


def test_upsert_replaces_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, date_key string, v int, seq int"
    writers.append(
        spark.createDataFrame([(1, "a", 10, 0), (2, "a", 20, 0), (3, "b", 30, 0)], schema),
        path,
        partition_by=["date_key"],
    )
    before = {p.name for p in (tmp_path / "t" / "date_key=b").iterdir()}
    new = spark.createDataFrame([(2, "a", 21, 1), (2, "a", 22, 2), (4, "c", 40, 1)], schema)
    writers.upsert(spark, new, path, ["k"], "seq")
    rows = sorted((r["k"], r["date_key"], r["v"]) for r in spark.read.parquet(path).collect())
    assert rows == [(1, "a", 10), (2, "a", 22), (3, "b", 30), (4, "c", 40)]
    # A partition without new rows is left alone.
    assert {p.name for p in (tmp_path / "t" / "date_key=b").iterdir()} == before


def test_upsert_keeps_stored_rows_of_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, date_key string, seq int"
    stored = spark.createDataFrame([(1, None, 0), (2, "a", 0)], schema)
    writers.append(stored, path, partition_by=["date_key"])
    writers.upsert(spark, spark.createDataFrame([(3, None, 1)], schema), path, ["k"], "seq")
    rows = {(r["k"], r["date_key"]) for r in spark.read.parquet(path).collect()}
    assert rows == {(1, None), (2, "a"), (3, None)}


def test_last_record_with_null_flags_gives_null_flags(spark):
    schema = "space_id bigint, ts timestamp, value int, is_online boolean, is_scenario boolean"
    at = datetime(2024, 1, 1, 0, 0)
    readings = spark.createDataFrame(
        [(1, at, 1, True, True), (1, at + timedelta(seconds=5), 2, None, False),
         (2, at, 5, None, None)], schema,
    )
    got = {r["space_id"]: r for r in minute_camera_sum(readings).collect()}
    assert (got[1]["value"], got[1]["is_online"], got[1]["is_scenario"]) == (3, None, False)
    assert (got[2]["is_online"], got[2]["is_scenario"], got[2]["ts"]) == (None, None, at)


def test_unshared_folder_off_one_machine_is_refused(monkeypatch, spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = type("C", (), {"get": lambda self, key, default=None: None})()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(Session())


def test_replaced_partitions_are_idempotent(spark, tmp_path):
    for unit in (1, 2, 2):
        writers.replace_partitions(spark.range(4).withColumn("unit", F.lit(unit)), str(tmp_path), ["unit"])
    assert spark.read.parquet(str(tmp_path)).count() == 8


def test_first_upsert_makes_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    new = spark.createDataFrame([(1, "a", 1), (1, "a", 2)], "k int, date_key string, seq int")
    writers.upsert(spark, new, path, ["k"], "seq")
    assert [(r["k"], r["seq"]) for r in spark.read.parquet(path).collect()] == [(1, 2)]


def test_loads_continue_from_the_stored_state_and_can_be_repeated(spark, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    at = datetime(2024, 1, 1)
    loads = [
        [(0, 5.0), (0.1, 6.0)],  # two readings of one second
        [(3 * 3600, 9.0)],
        [(5 * 3600, 2.0)],
    ]
    for n in (0, 1, 1, 2):
        rows = [(1, 1, 1, at + timedelta(seconds=s), True, False, x) for s, x in loads[n]]
        jobs.load_hours(spark, spark.createDataFrame(rows, HISTORY_READING), n, table, state)
    found = {(r["date_time_key"].hour, r["value"]) for r in spark.read.parquet(table).collect()}
    assert found == {(0, 6.0), (1, 6.0), (2, 6.0), (3, 9.0), (4, 2.0), (5, 2.0)}
    assert spark.read.parquet(table).count() == 6
    assert [r["value"] for r in jobs.last_known(spark, state, 3).collect()] == ["2.0"]
    assert [r["value"] for r in jobs.last_known(spark, state, 1).collect()] == ["6.0"]


def test_empty_registry_has_no_rows_only_when_asked(spark, tmp_path):
    assert readers.registry_scan(spark, str(tmp_path / "none"), missing_ok=True).count() == 0
    with pytest.raises(AnalysisException):
        readers.registry_scan(spark, str(tmp_path / "none"))


def test_retention(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1),), (datetime(2020, 4, 25),)], "ts timestamp"
    )
    kept = writers.retained(df, "ts", "2020-05-01 00:00:00")
    assert [r["ts"] for r in kept.collect()] == [datetime(2020, 4, 25)]


def test_csv_has_no_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    writers.csv_export(spark.createDataFrame([(1, "a")], "x int, y string"), path)
    writers.csv_export(spark.createDataFrame([(2, "b")], "x int, y string"), path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["1,a", "2,b"]


def test_registry_scan_keeps_keyed_rows_of_matching_tables(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame(
        [("DEVICE_A", "1-2-3", "1", "2", "3"), ("DEVICE_A", "123", "1", "2", "3"), ("OTHER", "4-5-6", "4", "5", "6")],
        "table string, key string, space_id string, zone_device_id string, zone_device_control_id string",
    )
    writers.write_registry(rows, root, "first")
    found = readers.registry_scan(spark, root, "table=DEVICE_*")
    assert [r["_id"] for r in found.collect()] == ["1-2-3"]
    assert dict(found.dtypes)["space_id"] == "bigint"
    assert readers.registry_scan(spark, root, "table=DEVICE_*", keyed_only=False).count() == 2


def test_topic_options():
    given = readers.topic_options("h:1", "t", group="g", max_per_trigger=10, **{"kafka.security.protocol": "SSL"})
    assert given == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "groupIdPrefix": "g",
        "maxOffsetsPerTrigger": "10",
        "kafka.security.protocol": "SSL",
    }


def test_jdbc_options():
    given = {"url": "jdbc:x", "user": "u", "fetchsize": "5"}
    plain = readers.jdbc_options("iot.t", given)
    assert plain == {**given, "dbtable": "iot.t"}
    split = readers.jdbc_options("iot.t", given, "id", 0, 100, 4)
    assert split["partitionColumn"] == "id"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "4")
    with pytest.raises(ValueError):
        readers.jdbc_options("iot.t", given, "id", 0)
