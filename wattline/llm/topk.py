"""Exact top-k by inner product with block-at-a-time pruning.

Rows are ordered along a space-filling curve and cut into document ranges of ``BLOCK_ROWS``: a block
keeps the largest and smallest value of every term (component), and its forward index, the rows
themselves. The bound of a block for a query is the sum of each weight times the term's maximum (or
minimum, for a negative weight). Per query, blocks are scored in the order of their bounds until the
bounds fall below the k-th score.

Queries are taken in chunks against shards of blocks. A first pass scores only the best block of each
shard; the k-th score over all shards then is the floor of the second pass, which scores whatever
block may still reach it. All arithmetic is on whole numbers below 2 ** 53 and so exact.

Defined results: vectors that are null, empty, or hold null or non-finite components, or whose size is
not the most common one, take no part; neither do null ids; zero vectors do. Candidate
rows that repeat an id are rows of their own; of query rows that repeat one, a single row asks. Ties go to the smaller id; fewer candidates than places give fewer rows. If
products could reach 2 ** 53 an error says so, instead of rounded scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.hilbert import hilbert_keys
from wattline.llm.shared import landed
from wattline.llm.vectors import finite, matrix, most_common_size, packed, unpacked

BLOCK_ROWS, SHARD_ROWS, CHUNK_ROWS = 128, 4096, 4096


def _trim(query, score, ids, k, others=()):
    """The k best of each query: highest score, then smallest id."""
    order = np.lexsort((ids, -score, query))
    query, score, ids = query[order], score[order], ids[order]
    first = np.ones(len(query), bool)
    first[1:] = query[1:] != query[:-1]
    begin = np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    keep = np.arange(len(query)) - begin < k
    return query[keep], score[keep], ids[keep]


def search_shard(
    q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int,
    only_best: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows of (query index, score, id) that hold each query's k best of the shard, as far as they
    reach ``floor``; and how many pairs of query and block were scored. ``x`` lies in block order."""
    starts = np.arange(0, len(x), BLOCK_ROWS)
    high, low = np.maximum.reduceat(x, starts), np.minimum.reduceat(x, starts)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = floor.astype(np.float64).copy()
    query, score, found = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
    scored = 0
    for turn in range(1 if only_best else len(starts)):
        block = order[:, turn]
        # A block whose bound equals the k-th score may hold a tie with a smaller id.
        active = np.flatnonzero(bounds[np.arange(len(q)), block] >= kth)
        if not len(active):
            break
        scored += len(active)
        news = []
        for b in np.unique(block[active]).tolist():
            who = active[block[active] == b]
            rows = slice(starts[b], starts[b] + BLOCK_ROWS)
            products = q[who] @ x[rows].T
            products[q_ids[who][:, None] == ids[rows]] = -np.inf
            hit, col = np.nonzero((products >= kth[who][:, None]) & (products > -np.inf))
            news.append((who[hit], products[hit, col], ids[rows][col]))
        query, score, found = (
            np.concatenate([old, *[n[i] for n in news]]) for i, old in enumerate((query, score, found))
        )
        query, score, found = _trim(query, score, found, k)
        counts = np.bincount(query, minlength=len(q))
        full = np.flatnonzero(counts == k)
        ends = np.cumsum(counts)
        kth[full] = np.maximum(kth[full], score[ends[full] - 1])
    return query, score, found, scored


def top_inner_products(
    vectors: DataFrame, is_query: Column, id_col: str, vector: str, k: int, scale: float = 256.0
) -> DataFrame:
    """query_id, rank (from 1), found_id and score: the ``k`` highest inner products of every row where
    ``is_query`` holds with all other rows, components being ``floor(scale * x)``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, found_id long, score long"
    sound = vectors.filter(finite(vector, allow_zero=True) & F.col(id_col).isNotNull())
    dims = most_common_size(sound, vector)
    if not dims:
        return spark.createDataFrame([], schema)
    sound = sound.filter(F.size(vector) == dims).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector).alias("vector"),
        is_query.alias("asks"),
    )
    rng = np.random.default_rng(5)
    axes = np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, : min(8, dims)]

    def quantize(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows = np.floor(scale * matrix(part.column("vector"), dims))
                size = np.sqrt((rows * rows).sum(1, keepdims=True)) + 1e-9
                grid = ((rows @ axes) / size * 0.5 + 0.5) * 127
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("asks"),
                        pa.array(hilbert_keys(np.clip(grid, 0, 127).astype(np.int64), 7)),
                        pa.array(np.abs(rows).max(1)), packed(rows.astype("<f8")),
                    ],
                    names=["id", "asks", "place", "largest", "v"],
                )

    rows = landed(
        sound.mapInArrow(quantize, "id long, asks boolean, place long, largest double, v binary"),
        "quantized",
    )
    largest = rows.agg(F.max("largest").alias("m")).first()["m"]
    if largest is not None and largest * largest * dims >= 2.0**53:
        raise ValueError("components are too large for exact scores")

    # Shards: neighbours on the curve, of near-equal size; queries in chunks.
    total, asking = rows.count(), rows.filter("asks").count()
    if not asking:
        return spark.createDataFrame([], schema)
    shards, chunks = -(-total // SHARD_ROWS), -(-asking // CHUNK_ROWS)
    shard = (
        rows.select("id", "place", "v")
        .repartitionByRange(shards, "place", "id")
        .withColumn("shard", F.spark_partition_id())
    )
    indexed = landed(shard, "shards")
    queries = (
        rows.filter("asks")
        .groupBy("id")
        .agg(F.min("v").alias("v"))
        .select("id", "v", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"))
    )

    def searched(floors: DataFrame | None, only_best: bool) -> DataFrame:
        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            out = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
            asked = np.empty(0, np.int64)
            if left.num_rows and right.num_rows:
                ids, place = left.column("id").to_numpy(), left.column("place").to_numpy()
                order = np.lexsort((ids, place))
                x = unpacked(left.column("v"), "<f8")[order]
                asked = right.column("id").to_numpy()
                least = right.column("floor").to_numpy()
                *out, _ = search_shard(
                    unpacked(right.column("v"), "<f8"), asked, least, x, ids[order], k, only_best
                )
            names = asked[out[0]] if len(out[0]) else out[2]
            return pa.table({
                "query_id": pa.array(names, pa.int64()),
                "found_id": pa.array(out[2], pa.int64()),
                "score": pa.array(out[1].astype(np.int64), pa.int64()),
            })

        asking = queries.withColumn("floor", F.lit(float("-inf")))
        if floors is not None:
            asking = queries.join(floors.withColumnRenamed("query_id", "id"), "id", "left")
            asking = asking.withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        # Each shard meets each chunk of queries once.
        cells = indexed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        return (
            cells.groupBy("shard", "chunk")
            .cogroup(asking.select("id", "v", "floor", "shard", "chunk").groupBy("shard", "chunk"))
            .applyInArrow(search, "query_id long, found_id long, score long")
        )

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "found_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best))
    floors = (
        ranked(searched(None, True))
        .filter(F.col("rank") == k)
        .select("query_id", F.col("score").cast("double").alias("floor"))
    )
    found = searched(landed(floors.groupBy("query_id").agg(F.max("floor").alias("floor")), "floors"), False)
    return ranked(found).filter(F.col("rank") <= k).select("query_id", "rank", "found_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    found = top_inner_products(
        embeddings.select("vec_id", "embedding"), F.pmod("vec_id", F.lit(50)) == 0, "vec_id", "embedding", 5
    )
    return found.withColumnRenamed("found_id", "vec_id")
