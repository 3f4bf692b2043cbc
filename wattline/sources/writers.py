"""Writers. Formats, paths and options come from the caller."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.lookup import settle
from wattline.operators.reduce import latest_by_key
from wattline.sources.readers import stored_or_empty

# Fixed value: how long readings are kept.
RETENTION_SECONDS = 10_000_000


def append(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Append to a table. A partitioned write is rebalanced on its partition columns first, which
    gives few files per partition and splits a partition that is much larger than the rest."""
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write
    writer = writer.format(fmt).mode("append").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path) if path else writer.save()


def retained(df: DataFrame, column: str, as_of: Any, seconds: int = RETENTION_SECONDS) -> DataFrame:
    """Rows that are not older than the retention time."""
    kind = df.schema[column].dataType
    oldest = F.lit(as_of).cast(kind) - F.make_dt_interval(secs=F.lit(seconds))
    return df.filter(F.col(column) >= oldest)


def replace_partitions(
    df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet"
) -> None:
    """Replace the partitions that the rows lie in. With the unit of work as last partition column,
    writing the same rows again changes nothing."""
    (
        df.hint("rebalance", *partition_by)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def merge_partitions(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    merge: Callable[[DataFrame], DataFrame],
    partition: str = "date_key",
    fmt: str = "parquet",
) -> None:
    """Merge rows into a table: ``merge`` makes of stored and new rows together the rows to keep.

    Only the partitions the new rows touch are read and replaced. The values of ``partition`` name
    directories, so their number is bounded by the calendar and not by the rows, and the list of them
    is what the driver gets. The first load makes the table.
    """
    stored = stored_or_empty(spark, path, new.schema, fmt)
    # Settled, so that the rows written are the rows whose partitions were read.
    new = settle(new.select(*stored.columns))
    touched = [row[0] for row in new.select(partition).distinct().collect()]
    at_partition = F.col(partition).isin([x for x in touched if x is not None])
    if None in touched:
        at_partition = at_partition | F.col(partition).isNull()
    replace_partitions(merge(stored.filter(at_partition).unionByName(new)), path, [partition], fmt)


def upsert(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: list[str],
    order: str,
    partition: str = "date_key",
    fmt: str = "parquet",
) -> None:
    """Insert rows that replace stored rows of an equal key; the greatest ``order`` wins, then the
    greatest record. ``partition`` must be a function of the keys."""
    whole = [*keys, partition] if partition not in keys else keys
    merge_partitions(spark, new, path, lambda rows: latest_by_key(rows, whole, order), partition, fmt)


def expire_partitions(
    spark: SparkSession, path: str, as_of: Any, column: str = "date_key", seconds: int = RETENTION_SECONDS
) -> list[str]:
    """Remove the date partitions of a table all of whose rows are older than the retention time.

    They are found from the names of the partition folders; no data file is opened. Their names are
    written to a marker below ``_expired`` first, so a run that is cut short is finished by the next
    one, and a repeated run changes nothing. Gives the dates removed.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    oldest = (datetime.fromisoformat(str(as_of)) - timedelta(seconds=seconds)).date().isoformat()
    names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    dates = (n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))
    # A date's last rows lie just before the next midnight.
    expired = sorted(d for d in dates if re.fullmatch(r"\d{4}-\d\d-\d\d", d) and d < oldest)
    if expired:
        marker = spark.createDataFrame([(d, str(as_of)) for d in expired], f"{column} string, as_of string")
        marker.coalesce(1).write.mode("append").json(f"{path}/_expired")
        for day in expired:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f"{column}={day}"), True)
    return expired


def jdbc_append(df: DataFrame, table: str, options: dict[str, str], connections: int = 8) -> None:
    """Append to a JDBC table over a bounded number of connections."""
    opts = {**options, "dbtable": table, "numPartitions": str(connections)}
    df.write.format("jdbc").mode("append").options(**opts).save()


def csv_export(df: DataFrame, path: str) -> None:
    """Append CSV files without a header."""
    df.write.mode("append").option("header", False).csv(path)


def publish(frame: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """Send frames of (topic, key, value)."""
    frame.write.format(fmt).mode("append").options(**options).save()


def write_registry(rows: DataFrame, root: str, unit: Column | str, fmt: str = "parquet") -> None:
    """Write devices below their registry table, in a directory of one unit of work per table."""
    (
        rows.withColumn("unit", F.lit(unit) if isinstance(unit, str) else unit)
        .withColumnRenamed("key", "_id")
        .hint("rebalance", "table")
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table", "unit")
        .save(root)
    )
