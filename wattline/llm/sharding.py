"""Shards of near-equal bytes by histogram sort. DataFrame functions only.

Documents are ordered by a 56-bit hash of id and text. Exact bytes and rows below candidate keys are
counted in every partition and summed; the range that holds a splitter is cut finer and counted again
until the splitter meets the tolerance or the range holds a single key. Only then is data exchanged,
once, and every row knows its shard and its slot there.

The driver sees histograms of at most ``2 ** FIRST_BITS`` and, later, ``2 ** NEXT_BITS`` ranges per
splitter, whatever the number of rows.

Defined results: a null text has no bytes, its row counts ``ROW_BYTES``; a null id hashes like any
other value; rows that repeat id and text share a key and stay together; a row larger than a shard
fills it alone, its neighbours may stay empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.shared import free_names, landed
from wattline.workspace import new_folder

ROW_BYTES = 16
KEY_BITS, FIRST_BITS, NEXT_BITS = 56, 16, 8


def row_bytes(text: str) -> Column:
    """UTF-8 bytes of the text and ``ROW_BYTES`` for the rest of the row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def sort_key(id_col: str, text: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(id_col, text), 64 - KEY_BITS)


def _histogram(keys: DataFrame, bits: int) -> DataFrame:
    """Bytes and rows per range of keys that agree in their first ``bits`` bits."""
    return keys.groupBy(F.shiftright("key", KEY_BITS - bits).alias("range")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> list[int]:
    """``shards - 1`` ascending keys; a shard takes keys from its splitter up to the next.

    ``keys`` has (key, bytes). A splitter is settled when the bytes below it miss their share by at
    most ``tolerance`` of a shard, or when its range holds one row or one key.
    """
    total = keys.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    goals = {s: total * s / shards for s in range(1, shards)}
    slack, settled = tolerance * total / shards, {}
    # By open range: the bytes below it, and the splitters that fall into it.
    unsettled = {0: (0, list(goals))} if total else {}
    inside, bits, step = keys, FIRST_BITS, FIRST_BITS
    while unsettled:
        children: dict[int, list] = {}
        for row in _histogram(inside, bits).collect():
            children.setdefault(row["range"] >> step, []).append(row)
        finer: dict[int, tuple[int, list[int]]] = {}
        for parent, (below, wanted) in unsettled.items():
            rows, at = sorted(children[parent]), 0
            for s in wanted:
                while at < len(rows) - 1 and below + rows[at]["bytes"] < goals[s]:
                    below += rows[at]["bytes"]
                    at += 1
                here = rows[at]
                under, over = goals[s] - below, below + here["bytes"] - goals[s]
                if min(under, over) <= slack or here["rows"] == 1 or bits == KEY_BITS:
                    settled[s] = (here["range"] + (over < under)) << (KEY_BITS - bits)
                else:
                    finer.setdefault(here["range"], (below, []))[1].append(s)
        inside = keys.filter(F.shiftright("key", KEY_BITS - bits).isin(list(finer)))
        unsettled, bits, step = finer, bits + NEXT_BITS, NEXT_BITS
    return [settled.get(s, 0) for s in range(1, shards)]


def assign_shards(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text: str = "text",
    tolerance: float = 0.001,
) -> DataFrame:
    """All rows and columns, and ``shard``, ``slot`` (from 0, gapless per shard) and ``bytes``.

    The law is ``bytes``: shards are of near-equal size; where the shards of two tables must agree by
    key, this is not the operator. Added columns get a leading underscore where names clash.
    """
    wishes = ("shard", "slot", "bytes", "sort_key", "range", "before", "passed", "inner")
    names = dict(zip(wishes, free_names(docs.columns, *wishes), strict=True))
    key, size = sort_key(id_col, text), row_bytes(text)
    keys = landed(docs.select(key.alias("key"), size.alias("bytes")), "shard-keys")
    cuts = find_splitters(keys, shards, tolerance)

    # One row per first range, at most 2 ** FIRST_BITS: rows before it, and the splitters around it.
    all_cuts = F.array(*[F.lit(c).cast("long") for c in cuts]).cast("array<long>")
    first_range = lambda c: F.shiftright(c, KEY_BITS - FIRST_BITS)
    ranges = (
        _histogram(keys, FIRST_BITS)
        .withColumn("before", F.sum("rows").over(Window.orderBy("range")) - F.col("rows"))
        .withColumn("all", all_cuts)
        .select(
            F.col("range").alias(names["range"]),
            F.col("before").alias(names["before"]),
            F.size(F.filter("all", lambda c: first_range(c) < F.col("range"))).alias(names["passed"]),
            F.filter("all", lambda c: first_range(c) == F.col("range")).alias(names["inner"]),
        )
    )
    keyed = docs.withColumns({names["sort_key"]: key, names["bytes"]: size})
    keyed = keyed.withColumn(names["range"], first_range(F.col(names["sort_key"])))
    # The one exchange of whole rows: partitions are runs of ranges, so each holds few shards, and the
    # ranks within ranges need no other.
    keyed = keyed.repartitionByRange(names["range"])
    in_range = Window.partitionBy(names["range"]).orderBy(names["sort_key"], id_col)
    placed = (
        keyed.withColumn(names["slot"], F.row_number().over(in_range) - 1)
        .join(F.broadcast(ranges), names["range"])
        .withColumn(
            names["shard"],
            F.col(names["passed"])
            + F.size(F.filter(names["inner"], lambda c: c <= F.col(names["sort_key"]))),
        )
    )
    # Rows below each splitter: what lies before its first range and, within it, below the splitter.
    firsts = _rows_below(keys, cuts)
    below = F.element_at(
        F.array(*[F.lit(n).cast("long") for n in [0, *firsts]]), F.col(names["shard"]) + 1
    )
    return placed.withColumn(
        names["slot"], (F.col(names["before"]) + F.col(names["slot"]) - below).cast("long")
    ).select(*docs.columns, names["bytes"], names["shard"], names["slot"])


def _rows_below(keys: DataFrame, cuts: list[int]) -> list[int]:
    """How many rows have keys below each splitter: one pass, a sum per splitter."""
    if not cuts:
        return []
    row = keys.agg(
        *[F.coalesce(F.sum((F.col("key") < F.lit(c)).cast("long")), F.lit(0)) for c in cuts]
    ).first()
    return list(row)


def write_shards(placed: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Write rows as :func:`assign_shards` places them, a folder per shard, in the order of their slots.
    They lie by key ranges already, so nothing is exchanged again."""
    placed.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per document: size, checksum of the text, and where it lies, read back from the shards."""
    folder = new_folder(docs.sparkSession, "shards")
    write_shards(assign_shards(docs.select("doc_id", "text"), shards), folder)
    stored = docs.sparkSession.read.schema("doc_id long, text string, bytes long, slot long, shard int")
    checksum = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return stored.parquet(folder).select(
        "doc_id",
        row_bytes("text").cast("long").alias("size"),
        checksum.alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
