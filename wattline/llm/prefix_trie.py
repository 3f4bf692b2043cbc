"""The trie of conversation prefixes, with counts and sums of every subtree.

A node is a distinct sequence of the first turns of conversations; its members are the conversations
that start with it. Nodes are named by a chain of digests, so that texts stay where they are.

1. Turns become digests and sizes in the scan. A conversation's prefix digests are made by one pass
   over its sorted turns; it may be longer than memory.
2. Distinct digests are enumerated by a grouped aggregate with map-side combine: members, the smallest
   of them (the owner), children. A first turn that a third of all conversations share is a row per
   task before the shuffle.
3. Sums over subtrees run in shards of conversations. A conversation brings its path, and what it adds
   are the nodes it owns, so every node is added in exactly one shard. A shard's distinct digests get
   slots of a minimal perfect hash (``slots``), each verified; counts are scattered into flat arrays
   by slot and accumulated through the parents' slots, deepest nodes first. Nodes above several
   shards get a partial sum from each, and the partial sums add up in another aggregate. So no
   subtree has to fit one task. Shards are cut between conversations, and a path's tail with a single
   member, which adds one childless node and nothing else, counts where it branches off and is not kept.
4. The ids that end at a node are joined piece by piece in a range partitioning by node and id; the
   pieces, in order, are hashed one after the other.

Defined results: turns are ordered by number, null first, repeated numbers by the digest of role and
text; a null role or text is empty; a family's remainder has the sign of the id; rows that repeat are turns of their own; rows without a
conversation id take no part; an empty table has no nodes, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.shared import landed
from wattline.llm.slots import SlotTable

#: Rows of paths that a shard holds at most, but for the last conversation.
SHARD_ROWS = 200_000
#: Bytes of joined ids in one piece.
PIECE_BYTES = 1 << 20
ROOT = hashlib.blake2b(b"", digest_size=16).digest()
#: Conversations that share a head, and how many lengths of a shared head there are.
FAMILY, HEADS = 5, 9


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, number, turn, size): turns in order, from 1, by digest, and the UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("at"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn"),
        F.octet_length(text).cast("long").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "turn", "size")
    return named.select("conv_id", F.row_number().over(order).alias("number"), "turn", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turn, size) of conversations whose head is that of the first of their family.

    ``conv_id`` c takes the first h turns of ``c - c % FAMILY`` and its own from h on, with h the
    checksum of its id modulo ``HEADS``. Every conversation also has a row of depth 0.
    """
    head: Column = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    counted = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    whole = counted.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), head.alias("head"))
    # A family's first turns, HEADS - 1 at most, go to its members, FAMILY at most.
    first = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("number") < HEADS))
    given = whole.join(first.withColumnRenamed("conv_id", "base"), "base").filter("number <= head")
    sizes = counted.filter(F.col("conv_id") % FAMILY == 0).toDF("base", "base_turns")
    shift = whole.join(sizes, "base", "left").select(
        "conv_id", "head", F.least("head", F.coalesce("base_turns", F.lit(0))).alias("taken")
    )
    own = turns.join(shift, "conv_id").filter("number > head")
    return (
        given.select("conv_id", F.col("number").alias("depth"), "turn", "size")
        .union(own.select("conv_id", (F.col("number") - F.col("head") + F.col("taken")).cast("int"), "turn", "size"))
        .union(counted.select("conv_id", F.lit(0), F.lit(None).cast("binary"), F.lit(0).cast("long")))
    )


_PATHS = "conv_id long, depth int, node binary, parent binary, size long, last boolean"


def paths(turns: DataFrame) -> DataFrame:
    """The node of every prefix of every conversation, its parent, and whether the conversation ends
    there. ``turns`` has conv_id, depth (from 0, without gaps), turn and size."""

    def chain(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple | None = None  # the row before, whose end is seen with the next one
        for batch in found:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "turn", "size")), strict=True):
                conv, depth, turn, size = row
                if depth == 0:
                    node, parent = ROOT, None
                else:
                    parent = kept[2]
                    node = hashlib.blake2b(parent + turn, digest_size=16).digest()
                if kept is not None:
                    out.append((*kept, depth == 0))
                kept = (conv, depth, node, parent, size)
            if out:
                yield _batch(out)
        if kept is not None:
            yield _batch([(*kept, True)])

    return (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "depth")
        .select("conv_id", "depth", "turn", "size")
        .mapInArrow(chain, _PATHS)
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["conv_id", "depth", "node", "parent", "size", "last"],
    )


def node_table(steps: DataFrame) -> DataFrame:
    """A row per node: node, parent, depth, size, conv_id (the owner), n_convs, n_children."""
    nodes = steps.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first("size").alias("size"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
    )
    nodes = landed(nodes, "nodes")
    children = nodes.filter("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    met = nodes.join(children.withColumnRenamed("parent", "node"), "node", "left")
    return landed(met.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "node-table")


class Shard:
    """Paths of whole conversations, and what their owned nodes add."""

    def __init__(self):
        self.rows = 0
        self.parts: list[tuple] = []

    def add(self, node, parent, depth, leaves, saved) -> None:
        self.parts.append((node, parent, depth, leaves, saved))
        self.rows += len(node)

    def sums(self) -> pa.RecordBatch:
        """Per distinct node of the shard: childless nodes and saved bytes below and at it."""
        node, parent, depth, leaves, saved = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        keys, first = np.unique(node, axis=0, return_index=True)
        table = SlotTable(keys)
        slot = table.slots(node)
        above = np.full(len(keys), -1)
        level = np.zeros(len(keys), np.int64)
        at = table.slots(keys)
        level[at] = depth[first]
        above[at] = np.where(depth[first] > 0, table.slots(parent[first]), -1)
        total = np.zeros((len(keys), 2), np.int64)
        np.add.at(total, slot, np.stack([leaves, saved], axis=1))
        order = np.argsort(-level, kind="stable")
        cuts = np.flatnonzero(np.diff(level[order])) + 1
        for same in np.split(order, cuts):
            same = same[above[same] >= 0]
            np.add.at(total, above[same], total[same])
        names = [k.tobytes() for k in table.keys]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array(total[:, 0]), pa.array(total[:, 1])],
            names=["node", "leaves", "saved"],
        )


def _digests(column: pa.Array) -> np.ndarray:
    raw = b"".join(x or bytes(16) for x in column.to_pylist())
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def subtree_sums(steps: DataFrame, nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(node, n_leaves, saved_tokens) of the nodes with several members; the others lead to one
    childless node and save nothing."""
    owned = nodes.select("conv_id", "depth", "n_convs", "n_children")
    marked = steps.select("conv_id", "depth", "node", "parent", "size").join(owned, ["conv_id", "depth"], "left")

    def shards(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, path, conv, owns, tail = Shard(), [], None, False, False

        def close() -> None:
            if owns:
                shard.add(*(np.concatenate(c) for c in zip(*path, strict=True)))
            path.clear()

        for batch in found:
            ids = batch.column("conv_id").to_numpy()
            depth = batch.column("depth").to_numpy().astype(np.int64)
            members = batch.column("n_convs").fill_null(0).to_numpy()
            children = batch.column("n_children").fill_null(0).to_numpy()
            size = batch.column("size").to_numpy()
            node, parent = _digests(batch.column("node")), _digests(batch.column("parent"))
            edge = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])).tolist() + [len(ids)]
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if b == a:
                    continue
                if ids[a] != conv:
                    close()
                    if shard.rows >= shard_rows:
                        yield shard.sums()
                        shard = Shard()
                    conv, owns, tail = ids[a], False, False
                own = members[a:b] > 0
                alone = np.flatnonzero(own & (members[a:b] == 1))
                end = a + int(alone[0]) if len(alone) else b
                owns = owns or bool(own.any())
                if end > a:
                    leaves = (own & (children[a:b] == 0))[: end - a].astype(np.int64)
                    saved = np.where(own, (members[a:b] - 1) * size[a:b], 0)[: end - a]
                    path.append((node[a:end], parent[a:end], depth[a:end], leaves, saved))
                if end < b and not tail:
                    # A tail with one member branches off here, or is the whole conversation.
                    tail = True
                    if path:
                        path[-1][3][-1] += 1
        close()
        if shard.rows:
            yield shard.sums()

    parts = (
        marked.repartition("conv_id")
        .sortWithinPartitions("conv_id", "depth")
        .mapInArrow(shards, "node binary, leaves long, saved long")
    )
    return parts.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def ends_of(steps: DataFrame) -> DataFrame:
    """(node, ends_sha256): hash of the ids of the conversations that end at a node, ascending and
    joined by commas. Ids are joined where the range partitioning puts them; then a node's pieces,
    which are few, are hashed in order, one in memory at a time."""

    def pieces(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, 0, [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)], pa.string())],
                names=["node", "first", "ids"],
            )

        for batch in found:
            for own, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if own != node or size > PIECE_BYTES:
                    if ids:
                        yield made()
                    node, first, ids, size = own, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield made()

    def hashes(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in found:
            out = []
            for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != node:
                    if state is not None:
                        out.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield _hashed(out)
        if state is not None:
            yield _hashed([(node, state.hexdigest())])

    ordered = (
        steps.filter("last").select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    )
    joined = ordered.mapInArrow(pieces, "node binary, first long, ids string")
    return (
        joined.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
        .mapInArrow(hashes, "node binary, ends_sha256 string")
    )


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    nodes, names = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(names, pa.string())], names=["node", "ends_sha256"])


def trie(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of conversations given as (conv_id, depth, turn, size); see :func:`rebuilt`."""
    steps = landed(paths(turns), "paths")
    nodes = node_table(steps)
    sums = subtree_sums(steps, nodes, shard_rows)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(parents, "parent", "left")
        .join(sums, "node", "left")
        .join(ends_of(steps), "node", "left")
        .select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.when(F.col("n_convs") > 1, F.col("n_leaves")).otherwise(1).alias("n_leaves"),
            F.when(F.col("n_convs") > 1, F.col("saved_tokens")).otherwise(0).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def digest(conversations: DataFrame) -> DataFrame:
    return trie(rebuilt(landed(turns_of(conversations), "turns")))
