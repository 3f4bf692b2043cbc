"""Starting streams that append to files, and running one over everything that is there."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Start streams with this number of state partitions; None leaves the session's setting.

    A stream takes the setting when it first starts and keeps it in its checkpoint. Adaptive
    execution does not shrink it, so it should fit the cores of the cluster.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if count is not None:
        spark.conf.set(key, count)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    trigger: dict | None = None,
    partition_by: list[str] | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to a table; offsets and state live in the checkpoint folder."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .options(**(options or {}))
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with state_partitions(stream.sparkSession, partitions):
        return (writer.trigger(**trigger) if trigger else writer).start()


def drain(spark: SparkSession, stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream over all available input into files below ``folder``, and read them."""
    query = start_append(
        stream,
        f"{folder}/out",
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
        partitions=spark.sparkContext.defaultParallelism,
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
