"""From raw documents to packed sequences: quality, near-duplicates, mixture, packing.

Each stage is one operator of ``wattline.llm`` with its decision applied, written as Parquet and read
again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import minhash, mixing, packing, quality
from wattline.llm.shared import free_name, landed, ship_package, stored_position

#: Share of unevenness between sources that the mixture takes away.
EVENNESS = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(docs, quality.train_quality(docs, labels))
    return scored.filter(free_name(docs.columns, "keep")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest id, and of its texts that with the least
    digest. Rows that are equal in id and text stay once."""
    ship_package(spark)
    key = free_name(docs.columns, "text_key")
    found = minhash.decisions(docs).filter("kept and doc_id is not null")
    chosen = found.groupBy("doc_id", "root").agg(F.min("text_key").alias(key))
    keyed = docs.filter("doc_id is not null").withColumn(key, minhash.text_key_of("text"))
    once = keyed.join(chosen.select("doc_id", key).distinct(), ["doc_id", key], "left_semi")
    nameless = docs.filter("doc_id is null")
    return once.dropDuplicates(["doc_id", key]).select(*docs.columns).union(nameless)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves their sources at the target weights."""
    ship_package(spark)
    return mixing.in_mixed_order(docs, evenness=EVENNESS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ``position`` and their places in sequences.

    The position is where the stage before has stored a document, so sequences follow the mixed order.
    Rows that do not come straight from stored files have no order; they are mixed here.
    """
    ship_package(spark)
    position = free_name(docs.columns, "position")
    stored = stored_position(docs)
    if stored is None:
        placed = mixing.with_position(docs, position, evenness=EVENNESS)
    else:
        placed = docs.withColumn(position, stored)
    return packing.digest_in_order(placed, position)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("mixture", mixed_sources),
    ("packing", packed_sequences),
]

# Classifier, sketches and tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
