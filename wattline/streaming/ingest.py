"""Streaming ingest: parse, keep live readings, and route every micro-batch.

The device tables are read once per batch and folded into one directory, which is kept for the batch
and measured there. New devices go to the registry as units; after every ``compact_every`` batches the
units fold into a snapshot, so that no batch lists more folders than that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.operators import enrich
from wattline.schemas import FLAGS, TRIPLE
from wattline.sources import registry
from wattline.sources.writers import publish, replace_partitions

FACTS = ["kind", *TRIPLE, "ts", *FLAGS, "value_double", "value_int"]


@dataclass(frozen=True)
class Tables:
    """The device tables, read anew for every micro-batch."""

    registry: Callable[[SparkSession], DataFrame]
    invalid: Callable[[SparkSession], DataFrame]
    master: Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class Targets:
    """Where a micro-batch goes. Facts lie below ``date_key=.../kind=.../batch_id=...``. Without topic
    options no messages are published; without a folder for them, refused texts are dropped."""

    facts: str
    registry: str
    fmt: str = "parquet"
    topic_fmt: str = "kafka"
    topic_options: dict[str, str] | None = None
    topics: dict[str, str] = field(default_factory=lambda: dict(enrich.TOPICS))
    refused: str | None = None
    compact_every: int = 50


def write_batch(batch: DataFrame, batch_id: int, tables: Tables, targets: Targets) -> None:
    """Route one micro-batch and write it. Facts and registry rows go to directories of this batch
    (facts below their date and kind, so that later scans prune), and a batch that is run again after
    a failure replaces what it wrote; messages are published at least once."""
    spark = batch.sparkSession
    directory = enrich.device_directory(
        tables.registry(spark), tables.invalid(spark), tables.master(spark)
    ).persist(StorageLevel.MEMORY_AND_DISK)
    routed = enrich.typed_values(enrich.classify_by(enrich.live(batch), directory)).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        facts = routed.filter(F.col("kind").isNotNull()).select(
            *FACTS, F.to_date("ts").alias("date_key"), F.lit(batch_id).alias("batch_id")
        )
        replace_partitions(facts, targets.facts, ["date_key", "kind", "batch_id"], targets.fmt)
        if targets.topic_options is not None:
            sent = enrich.messages(routed, targets.topics, batch_id)
            publish(sent, targets.topic_options, targets.topic_fmt)
        registry.write_unit(
            spark, enrich.registry_rows(routed), targets.registry, str(batch_id), targets.fmt
        )
    finally:
        routed.unpersist()
        directory.unpersist()
    if batch_id % targets.compact_every == targets.compact_every - 1:
        registry.compact(spark, targets.registry, targets.fmt)


def write_messages(batch: DataFrame, batch_id: int, tables: Tables, targets: Targets) -> None:
    """Route the messages of one micro-batch; texts that could not be read go to a folder of the batch."""
    if targets.refused is not None and "refused" in batch.columns:
        texts = batch.filter("refused is not null").select("refused", F.lit(batch_id).alias("batch_id"))
        replace_partitions(texts, targets.refused, ["batch_id"], targets.fmt)
    write_batch(enrich.flatten(batch.filter("data is not null")), batch_id, tables, targets)


def start_ingest(
    messages: DataFrame,
    tables: Tables,
    targets: Targets,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start ingest of a stream with the parsed message in ``data``, and what could not be read in
    ``refused`` if there is such a column. A query name must be the only one of the session; without it
    several streams can run side by side."""
    writer = (
        messages.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_messages(batch, batch_id, tables, targets))
    )
    if name is not None:
        writer = writer.queryName(name)
    return (writer.trigger(**trigger) if trigger else writer).start()
