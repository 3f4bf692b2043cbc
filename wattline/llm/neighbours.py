"""Approximate nearest neighbours by several shifted Hilbert orderings.

Every ordering projects the vectors on a few random directions, shifts the grid, and sorts by Hilbert
key: Spark range-partitions all orderings at once. A query's candidates are the vectors within
``window`` places of it in any ordering; the candidates of all orderings are merged and ranked by
exact distance on the original vectors.

The window is calibrated, not guessed: for a bounded sample of queries the true neighbours are found
by brute force, and the window becomes the least that holds the wanted share of them. On vectors with
structure it is small. Vectors without structure (independent components in many dimensions) have no
ordering that brings neighbours together; the window then grows to a share of the table, and so does
the work per query.

Equal vectors are indexed once with their smallest ids, as many as a result has places, so any number
of copies is one row.

Defined results: vectors that are null, zero, or hold null or non-finite components, and those whose
size is not the most common one, take no part, neither as query nor as candidate; a null id takes no
part; rows that repeat id and vector are one candidate, and of query rows that repeat an id one asks; fewer candidates than places give fewer rows;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.hilbert import hilbert_keys
from wattline.llm.shared import hashed_order, landed
from wattline.llm.vectors import finite, matrix, most_common_size, packed, unpacked

ORDERINGS, DIRECTIONS, BITS = 16, 8, 7
#: Rows that fit the grid, queries that calibrate, and the share of true neighbours a window must hold.
FIT_ROWS, CALIBRATION_QUERIES, WANTED_RECALL = 10_000, 64, 0.97
#: Rows per cell of the window join.
CELL_ROWS = 4096


class Orderings:
    """Projections, grids and shifts; small, and the same for the same seed and sample."""

    def __init__(self, sample: np.ndarray, seed: int = 11):
        rng, dims = np.random.default_rng(seed), sample.shape[1]
        self.directions = min(DIRECTIONS, dims)
        self.axes, self.low, self.span = [], [], []
        for _ in range(ORDERINGS):
            axes = np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, : self.directions]
            seen = sample @ axes
            low, high = np.quantile(seen, 0.0005, axis=0), np.quantile(seen, 0.9995, axis=0)
            span = np.maximum(high - low, 1e-12)
            self.axes.append(axes)
            # The grid is twice as wide as the data and shifted by up to the width of the data.
            self.low.append(low - span * rng.uniform(0, 1, self.directions))
            self.span.append(2 * span)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, orderings) of Hilbert keys; what lies beyond the grid takes its edge."""
        out = np.empty((len(vectors), ORDERINGS), np.int64)
        for i in range(ORDERINGS):
            share = (vectors @ self.axes[i] - self.low[i]) / self.span[i]
            grid = np.clip(share * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            out[:, i] = hilbert_keys(grid, BITS)
        return out


def distinct_vectors(vectors: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    """(gid, members, vector): each distinct vector once, with its ``k + 1`` smallest ids."""
    order = Window.partitionBy("vector").orderBy("id")
    ids = (
        vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
        .withColumn("n", F.dense_rank().over(order))
        .filter(F.col("n") <= k + 1)
    )
    grouped = ids.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("members"))
    return grouped.select(F.col("members")[0].alias("gid"), "members", "vector")


def _nearest(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``q`` the indexes and exact distances of its ``k`` nearest rows of ``x``."""
    rough = (q * q).sum(1)[:, None] + (x * x).sum(1) - 2 * (q @ x.T)
    k = min(k, len(x))
    take = min(k + 6, len(x))
    near = np.argpartition(rough, take - 1, axis=1)[:, :take]
    exact = np.sqrt(((q[:, None, :] - x[near]) ** 2).sum(2))
    order = np.lexsort((near, exact), axis=1)[:, :k]
    return np.take_along_axis(near, order, 1), np.take_along_axis(exact, order, 1)


def _places(keyed: DataFrame) -> DataFrame:
    """``keyed`` (ordering, hkey, gid, ...) with ``place``, the position over all orderings in turn.

    One range partitioning for all orderings; positions are counted per partition and added up.
    """
    ordered = (
        keyed.repartitionByRange("ordering", "hkey", "gid")
        .sortWithinPartitions("ordering", "hkey", "gid")
        .withColumn("at", F.monotonically_increasing_id())
    )
    ordered = landed(ordered, "orderings").withColumns({
        "part": F.shiftright("at", 33),
        "in_part": F.col("at").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    # One row per partition, summed up in their order.
    before = (
        ordered.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
        .drop("n")
    )
    return ordered.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("in_part"))


def calibrated_window(
    placed: DataFrame, distinct: DataFrame, queries: DataFrame, k: int, dims: int, kind: str
) -> int:
    """The least window that holds ``WANTED_RECALL`` of the true neighbours of sample queries.

    Sample queries and their neighbours, ``CALIBRATION_QUERIES * k`` rows, are sent to every task.
    """
    sample = queries.orderBy(hashed_order("gid"), "gid").limit(CALIBRATION_QUERIES).collect()
    if not sample:
        return 1
    gids = np.array([r["gid"] for r in sample])
    q = np.array([r["vector"] for r in sample], np.float64)

    def scan(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            near, exact = _nearest(q, matrix(batch.column("vector"), dims), k + 1)
            owner = np.repeat(np.arange(len(q)), near.shape[1])
            ids = batch.column("gid").to_numpy()[near.ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gids[owner]), pa.array(ids), pa.array(exact.ravel())], names=["q", "gid", "d"]
            )

    best = Window.partitionBy("q").orderBy("d", "gid")
    true = (
        distinct.select("gid", "vector")
        .mapInArrow(scan, "q long, gid long, d double")
        .filter("q <> gid")
        .withColumn("n", F.row_number().over(best))
        .filter(F.col("n") <= k)
        .select("q", "gid")
    )
    true = landed(true, "true-neighbours")
    spots = placed.select("gid", "ordering", "place")
    of_true = spots.join(F.broadcast(true), "gid")
    of_query = spots.toDF("q", "ordering", "own").join(
        F.broadcast(true.select("q").distinct()), "q"
    )
    gaps = (
        of_true.join(of_query, ["q", "ordering"])
        .groupBy("q", "gid")
        .agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("gap"))
    )
    found = gaps.agg(F.percentile("gap", F.lit(WANTED_RECALL)).alias("w")).first()["w"]
    return max(1, int(np.ceil(found))) if found is not None else 1


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, id_col: str, vector: str, k: int, window: int | None = None
) -> DataFrame:
    """query_id, rank (from 1), neighbour_id and distance of the ``k`` nearest candidates found for
    every row where ``is_query`` holds, among all other rows; ties go to the smaller id."""
    spark = vectors.sparkSession
    sound = vectors.filter(finite(vector, allow_zero=False) & F.col(id_col).isNotNull())
    dims = most_common_size(sound, vector)
    sound = sound.filter(F.size(vector) == dims)
    schema = "query_id long, rank int, neighbour_id long, distance double"
    if not dims:
        return spark.createDataFrame([], schema)
    own = (
        sound.filter(is_query).groupBy(F.col(id_col).alias("query_id")).agg(F.min(vector).alias("vector"))
    )
    distinct = landed(distinct_vectors(sound, id_col, vector, k), "vectors")
    kind = "f4" if "float" in distinct.schema["vector"].simpleString() else "f8"

    # The queries of one distinct vector are one search.
    asked = landed(distinct.select("gid", "vector").join(own, "vector").select("gid", "query_id"), "asked")
    asked_gids = asked.select("gid").distinct()
    searches = distinct.join(asked_gids, "gid", "left_semi")

    sample = distinct.orderBy(hashed_order("gid"), "gid").select("vector").limit(FIT_ROWS).collect()
    orderings = Orderings(np.array([r["vector"] for r in sample], np.float64).reshape(-1, dims))

    def key(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = matrix(part.column("vector"), dims)
                keys = orderings.keys(rows)
                each = np.repeat(np.arange(len(rows)), ORDERINGS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(ORDERINGS, dtype=np.int32), len(rows))),
                        pa.array(keys.ravel()),
                        part.column("gid").take(pa.array(each)),
                        packed(rows.astype(kind)).take(pa.array(each)),
                    ],
                    names=["ordering", "hkey", "gid", "v"],
                )

    placed = _places(
        distinct.select("gid", "vector").mapInArrow(key, "ordering int, hkey long, gid long, v binary")
    )
    if window is None:
        window = calibrated_window(placed, distinct, searches, k, dims, kind)
    cell_rows = max(1, min(window, CELL_ROWS))
    reach = -(-window // cell_rows)

    rows = placed.select("ordering", "place", "gid", "v", F.floor(F.col("place") / cell_rows).alias("cell"))
    spots = placed.join(asked_gids, "gid", "left_semi").select(
        "ordering", "place", "gid", "v",
        F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("step"),
        F.floor(F.col("place") / cell_rows).alias("home"),
    )
    spots = spots.withColumn("cell", F.col("home") + F.col("step")).drop("step", "home")
    # Both come from one table; new names tell their columns apart.
    spots = spots.toDF(*spots.columns)

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            x, gid = unpacked(left.column("v"), kind).astype(np.float64), left.column("gid").to_numpy()
            place, curve = left.column("place").to_numpy(), left.column("ordering").to_numpy()
            q, qid = unpacked(right.column("v"), kind).astype(np.float64), right.column("gid").to_numpy()
            at, own = right.column("place").to_numpy(), right.column("ordering").to_numpy()
            for i in range(len(q)):
                near = np.flatnonzero((np.abs(place - at[i]) <= window) & (curve == own[i]))
                if len(near):
                    pick, exact = _nearest(q[i : i + 1], x[near], k + 1)
                    found += zip([int(qid[i])] * len(pick[0]), gid[near[pick[0]]].tolist(), exact[0].tolist(), strict=True)
        a, b, c = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"q": pa.array(a, pa.int64()), "gid": pa.array(b, pa.int64()), "distance": pa.array(c, pa.float64())})

    found = (
        rows.groupBy("cell")
        .cogroup(spots.groupBy("cell"))
        .applyInArrow(rank, "q long, gid long, distance double")
        .distinct()
    )
    # The k + 1 nearest distinct vectors hold the k nearest ids.
    best = Window.partitionBy("q").orderBy("distance", "gid")
    groups = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    members = distinct.select("gid", F.explode("members").alias("neighbour_id"))
    top = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return (
        groups.join(members, "gid")
        .join(asked.withColumnRenamed("gid", "q"), "q")
        .filter("neighbour_id <> query_id")
        .withColumn("rank", F.row_number().over(top))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "neighbour_id", "distance")
    )


def digest(embeddings: DataFrame) -> DataFrame:
    found = nearest_neighbours(
        embeddings.select("vec_id", "embedding"), F.pmod("vec_id", F.lit(100)) == 0, "vec_id", "embedding", 10
    )
    return found.select(
        "query_id", "rank", F.col("neighbour_id").alias("vec_id"), F.col("distance").alias("score")
    )
