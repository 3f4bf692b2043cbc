"""Best-fit packing of tokenized documents into sequences of one length.

Documents are cut into pieces of at most ``capacity`` ids. The plan is made over the histogram of
piece lengths, at most ``capacity`` numbers, not over pieces: best fit in order of decreasing length,
for runs of equal sequences at a time. Pieces then take planned slots by joining on their rank within
their length; ranks are counted per length and hash bucket first, so a length that a third of all
pieces have is no single group.

Documents in a given order are packed by windows of consecutive positions, each with a plan of its own
that a task makes; the sequences of a window come before those of the next, so that what the order
promises holds for consecutive sequences. At most the last sequences of a window stay unfilled.

Defined results: a null text is empty and is one piece of the end id; every row is a document of its
own, also where an id is null or repeats; an empty table packs into nothing.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.shared import free_names, landed
from wattline.llm.tokens import encoder, ids_crc32

RANK_BUCKETS = 512
#: Positions that are packed together where documents have an order.
WINDOW_ROWS = 1024
#: Windows whose sequences are counted together first: one row for some four million documents.
RANGE_WINDOWS = 4096
ROWS_AT_ONCE = 256


def token_pieces(
    docs: DataFrame, vocabulary: str, lower: bool, end_id: int, capacity: int, position: str | None = None
) -> DataFrame:
    """Pieces of (doc_id, text) documents: doc_id, piece, start, length, ids_crc32 and ``ids``, the
    packed little-endian ids (2 bytes each where the vocabulary fits, else 4). The column
    ``position``, where it is named, is handed on under that name."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    if position:
        schema += ", position long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, lower)
        kinds = pa.schema(
            [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64())]
            + [("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
            + [("position", pa.int64())] * bool(position)
        )
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part, rows = batch.slice(at, ROWS_AT_ONCE), []
                names = part.column("doc_id").to_pylist()
                carried = zip(part.column("position").to_pylist()) if position else [()] * len(names)
                for name, ids, more in zip(
                    names, encode.encode(part.column("text").to_pylist()), carried, strict=True
                ):
                    ids = np.append(ids, encode.dtype.type(end_id))
                    for i, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start : start + capacity]
                        rows.append((name, i, start, len(own), ids_crc32(own), own.tobytes(), *more))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k.type) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    schema=kinds,
                )

    carried = [F.col(position).cast("long").alias("position")] if position else []
    return docs.select("doc_id", "text", *carried).mapInArrow(cut, schema)


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit in order of decreasing length, over counts.

    Rows of (length, first rank, end rank, sequence of the first rank, offset): pieces of that length
    and rank lie at that offset, each in the next sequence. Their number is bounded by the square of
    the capacity, whatever the number of pieces.
    """
    rows, sequences = [], 0
    runs: dict[int, list[tuple[int, int]]] = {}  # by room left: runs of sequences
    rooms: list[int] = []  # the rooms that have runs, ascending

    def keep(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
                used = min(count, left)
                keep(room, first + used, count - used)
                rows.append((length, rank, rank + used, first, capacity - room))
                keep(room - length, first, used)
                rank, left = rank + used, left - used
                continue
            # Only new sequences can take the rest; each is filled before the next is opened.
            each = capacity // length
            for fill, count in ((each, left // each), (left % each, 1)):
                if fill and count:
                    for j in range(fill):
                        rows.append((length, rank, rank + count, sequences, j * length))
                        rank += count
                    keep(capacity - fill * length, sequences, count)
                    sequences += count
            left = 0
    return rows


def pack(pieces: DataFrame, capacity: int, keys: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) and the ``sequence_id`` and ``offset`` of
    each. ``pieces`` is read three times and so should be a stored table."""
    sequence_id, offset, bucket_, before_, within_, rank_, length_, from_, to_, first_ = free_names(
        pieces.columns, "sequence_id", "offset", "bucket", "before", "within", "rank", "of_length", "from", "to", "first"
    )
    counted = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    plan = plan_slots({r["length"]: r["count"] for r in counted}, capacity)
    slots = pieces.sparkSession.createDataFrame(
        plan, "length long, first long, end long, sequence long, offset long"
    ).toDF(length_, from_, to_, first_, offset)
    if len(plan) <= capacity * 64:
        slots = F.broadcast(slots)
    spread = pieces.withColumn(bucket_, F.pmod(F.xxhash64(*keys), F.lit(RANK_BUCKETS)))
    before = (
        spread.groupBy("length", bucket_)
        .count()
        .withColumn(
            before_,
            F.sum("count").over(Window.partitionBy("length").orderBy(bucket_)) - F.col("count"),
        )
        .drop("count")
    )
    within = Window.partitionBy("length", bucket_).orderBy(*keys)
    ranked = spread.withColumn(within_, F.row_number().over(within) - 1).join(
        before, ["length", bucket_]
    )
    rank = F.col(before_) + F.col(within_)
    return (
        ranked.withColumn(rank_, rank)
        .join(
            slots,
            (F.col("length") == F.col(length_))
            & (F.col(from_) <= F.col(rank_))
            & (F.col(rank_) < F.col(to_)),
        )
        .withColumn(sequence_id, F.col(first_) + F.col(rank_) - F.col(from_))
        .select(*pieces.columns, sequence_id, offset)
    )


def pack_in_order(pieces: DataFrame, capacity: int, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``pieces`` with a ``position`` and the ``sequence_id`` and ``offset`` of each, packed by windows
    of positions. Within a window the pieces of a length take their places by position."""
    sequence_id, offset, window_, number_, length_, from_, to_, first_, size_, base_, rank_, range_ = free_names(
        pieces.columns, "sequence_id", "offset", "window", "number", "of_length", "from", "to", "first", "size",
        "base", "rank", "range",
    )
    spread = pieces.withColumn(window_, F.expr(f"position div {window_rows}"))

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = ("number", "length", "start", "end", "sequence", "offset", "size")
        for row in (r for batch in batches for r in batch.to_pylist()):
            rows = plan_slots({c["length"]: c["count"] for c in row["counts"]}, capacity)
            size = max(first + end - rank for _, rank, end, first, _ in rows)
            columns = zip(*((row["window"], *r, size) for r in rows), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=kinds)

    counts = spread.groupBy(F.col(window_).alias("window"), "length").count()
    each = counts.groupBy("window").agg(F.collect_list(F.struct("length", "count")).alias("counts"))
    kinds = "number long, length long, start long, end long, sequence long, offset long, size long"
    slots = landed(each.mapInArrow(plan, kinds), "window-plans")
    slots = slots.toDF(number_, length_, from_, to_, first_, offset, size_)
    # How many sequences the windows before each have: in earlier ranges of windows, and in its own.
    sizes = slots.select(number_, size_, F.expr(f"{number_} div {RANGE_WINDOWS}").alias(range_)).distinct()
    earlier = Window.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy(range_).orderBy(number_).rowsBetween(Window.unboundedPreceding, -1)
    sums = sizes.groupBy(range_).agg(F.sum(size_).alias(size_))
    starts = sums.select(range_, F.coalesce(F.sum(size_).over(earlier), F.lit(0)).alias(from_))
    within_range = sizes.select(number_, range_, F.coalesce(F.sum(size_).over(own), F.lit(0)).alias(base_))
    bases = within_range.join(starts, range_).select(number_, (F.col(base_) + F.col(from_)).alias(base_))
    within = Window.partitionBy(window_, "length").orderBy("position", "piece")
    return (
        spread.withColumn(rank_, F.row_number().over(within) - 1)
        .join(
            slots.join(bases, number_),
            (F.col(window_) == F.col(number_))
            & (F.col("length") == F.col(length_))
            & (F.col(from_) <= F.col(rank_))
            & (F.col(rank_) < F.col(to_)),
        )
        .withColumn(sequence_id, F.col(base_) + F.col(first_) + F.col(rank_) - F.col(from_))
        .select(*pieces.columns, sequence_id, offset)
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, lower: bool, end_id: int, capacity: int
) -> DataFrame:
    """Tokenize, cut and pack whole documents."""
    pieces = token_pieces(docs, vocabulary, lower, end_id, capacity)
    return pack(landed(pieces, "pieces"), capacity)


def digest(docs: DataFrame) -> DataFrame:
    """Pieces of the contract: every document's ids and an id 0, in sequences of 2048."""
    from wattline.llm.tokens import vocabulary_path

    packed = pack_documents(docs, vocabulary_path("word_bpe_49k.json"), True, 0, 2048)
    return packed.drop("ids")


def digest_in_order(docs: DataFrame, position: str) -> DataFrame:
    """:func:`digest` of documents with a position, by windows of positions."""
    from wattline.llm.tokens import vocabulary_path

    pieces = token_pieces(docs, vocabulary_path("word_bpe_49k.json"), True, 0, 2048, position)
    return pack_in_order(landed(pieces, "pieces"), 2048).drop("ids")
