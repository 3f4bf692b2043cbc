"""The device registry as a numbered snapshot and the units of work written since.

Below a root, ``tail=N`` holds the units written after snapshot N, a folder per table and unit, and
``snapshot=N`` all devices of snapshot N-1 and its tail, one row per table and key. A snapshot counts
from the moment its number stands in ``complete``. Readers take the newest complete snapshot and its
tail, so the folders they list are bounded by how often the registry is compacted, not by its age.

One writer is assumed, as a stream is. A unit that is run again after a compaction writes its devices
into the new tail once more; reading folds them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.reduce import latest_by_key
from wattline.sources.readers import registry_scan, stored_or_empty
from wattline.sources.writers import write_registry

_COMPLETE = "number int"


def newest_snapshot(spark: SparkSession, root: str) -> int:
    """Number of the newest complete snapshot, 0 before the first."""
    return stored_or_empty(spark, f"{root}/complete", _COMPLETE).agg(F.max("number")).first()[0] or 0


def write_unit(spark: SparkSession, rows: DataFrame, root: str, unit: str, fmt: str = "parquet") -> None:
    """Write the devices of one unit of work; the same unit again replaces what it wrote."""
    write_registry(rows, f"{root}/tail={newest_snapshot(spark, root)}", unit, fmt)


def devices(
    spark: SparkSession, root: str, tables: str = "DEVICE_*", fmt: str = "parquet", keyed_only: bool = True
) -> DataFrame:
    """One row per table and key of the tables that match a glob; the last unit written wins."""
    number = newest_snapshot(spark, root)
    at = lambda part: registry_scan(
        spark, f"{root}/{part}={number}", f"table={tables}", fmt, keyed_only=keyed_only, missing_ok=True
    )
    tail = at("tail").withColumn("unit", F.col("unit").cast("string"))
    rows = tail.unionByName(at("snapshot"), allowMissingColumns=True) if number else tail
    # Units are numbers of micro-batches, or names that come before all of them.
    rows = rows.withColumn("order", F.coalesce(F.col("unit").try_cast("long"), F.lit(-1)))
    return latest_by_key(rows, ["table", "_id"], "order").drop("order")


def compact(spark: SparkSession, root: str, fmt: str = "parquet") -> int:
    """Fold the newest snapshot and its tail into the next snapshot; gives its number. A snapshot that was
    cut short is not complete and is written again."""
    number = newest_snapshot(spark, root) + 1
    rows = devices(spark, root, "*", fmt, keyed_only=False)
    rows.hint("rebalance", "table").write.format(fmt).mode("overwrite").partitionBy("table").save(
        f"{root}/snapshot={number}"
    )
    spark.createDataFrame([(number,)], _COMPLETE).coalesce(1).write.mode("append").parquet(f"{root}/complete")
    return number
