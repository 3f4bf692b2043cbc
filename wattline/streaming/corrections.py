"""Hours that late readings correct, in a table with one row per device and hour.

A windowed stream drops what arrives after its window has closed. Here every micro-batch is reduced to
one record per device and hour, and merged into the stored hours by key: the greater value stays, then
the later time. The merge is commutative and changes nothing when a batch is run again, so readings may
come in any order and however late. Only the blocks a batch touches are read and replaced; those are the
running one and what came late. ``block_hours`` sets how much is replaced at once: a day, or fewer
hours where a day of all devices is large.

Each batch also notes the newest time it has seen. That tells the rows a watermark would have refused
from the others, and readers which hours are closed.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.functions.timecols import interval
from wattline.operators.reduce import hourly_best
from wattline.schemas import FLAGS, TRIPLE
from wattline.sources.readers import scan, stored_or_empty
from wattline.sources.writers import replace_partitions, upsert

HOURS, MARKS = "hours", "marks"
_MARK = "newest timestamp, rows long, late_rows long, batch_id long"
#: Minutes that an hour stays open after its end.
LATENESS = 10
#: Hours that are stored in one folder and replaced together.
BLOCK_HOURS = 24


def _block(hour: str, hours: int) -> Column:
    """The first hour of the block an hour lies in, as a number; it names the folder."""
    first = F.hour(hour) - F.hour(hour) % hours
    return (F.date_format(hour, "yyyyMMdd").cast("int") * 100 + first).alias("block")


def newest_before(spark: SparkSession, root: str, batch_id: int) -> Any:
    """The newest time of the batches before this one; null before the first."""
    marks = stored_or_empty(spark, f"{root}/{MARKS}", _MARK)
    return marks.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]


def write_batch(
    batch: DataFrame, batch_id: int, root: str, lateness: int = LATENESS, block_hours: int = BLOCK_HOURS
) -> None:
    """Merge one micro-batch into the hours, and note its newest time and how many rows came late."""
    spark = batch.sparkSession
    newest = newest_before(spark, root, batch_id)
    hour_end = F.date_trunc("hour", "ts") + interval(hours=1)
    refused = hour_end <= F.lit(newest).cast("timestamp") - interval(minutes=lateness)
    hours = hourly_best(batch).select("*", _block("date_time_key", block_hours))
    upsert(spark, hours, f"{root}/{HOURS}", [*TRIPLE, "date_time_key"], "value", "block")
    mark = batch.agg(
        F.max("ts").alias("newest"), F.count(F.lit(1)).alias("rows"), F.count_if(refused).alias("late_rows")
    )
    replace_partitions(mark.withColumn("batch_id", F.lit(batch_id)), f"{root}/{MARKS}", ["batch_id"])


def start_corrected_hours(
    readings: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    lateness: int = LATENESS,
    block_hours: int = BLOCK_HOURS,
) -> StreamingQuery:
    """Start the stream of typed readings into the table below ``root``."""
    writer = (
        readings.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, root, lateness, block_hours))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def corrected_hours(
    spark: SparkSession, root: str, closed_only: bool = False, lateness: int = LATENESS
) -> DataFrame:
    """The record of every device and hour; with ``closed_only`` without hours that are still open."""
    hours = scan(spark, path=f"{root}/{HOURS}")
    if closed_only:
        newest = scan(spark, path=f"{root}/{MARKS}").agg(F.max("newest").alias("newest"))
        hours = hours.join(F.broadcast(newest)).filter(  # one row
            F.col("date_time_key") + interval(hours=1) <= F.col("newest") - interval(minutes=lateness)
        )
    return hours.select(*TRIPLE, *FLAGS, "value", "date_time_key")
