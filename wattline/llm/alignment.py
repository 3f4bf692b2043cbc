"""Alignment of two tokenizations of the same texts.

Both vocabularies cut the same bytes, so the byte offsets at which tokens end can be compared. Per
document the ends of each side go into a dictionary from end to index; the common keys, sorted, slice
both id lists into groups, and within the slices tokens whose byte ranges overlap are links.

Documents are tokenized once. What a document hands on is its numbers and its distinct linked id pairs
with how often each is linked. Those pairs are counted over all documents by a grouped aggregate with
map-side combine, and met again with the counts: the table of counts is sent to every task if it is
measured to be small, and is shuffled otherwise, where adaptive execution splits what a frequent pair
holds. The rows of one document then fold where they are.

Side A is a byte-level vocabulary of the tokenizers library, side B a sentencepiece model with byte
fallback; strings of special tokens in a text are plain text to both. A gets the text after a space,
B adds that space itself.

Defined results: null and empty texts, and those whose bytes one of the sides does not give back, have
no tokens: zeros and the empty string. Equal rows, and rows whose ids are null or repeated, are
documents of their own. Counting a pair once per document counts equal texts as often as they come. An
empty table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.shared import landed
from wattline.llm.tokens import PieceEncoder, encoder, vocabulary_path
from wattline.operators.lookup import lookup_join

#: Texts that are tokenized at once.
TEXTS_AT_ONCE = 256
#: Bits of a linked pair that hold the id of side B.
B_BITS = 24


class Entries:
    """The bytes of every id of a vocabulary, as arrays."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.sizes[ids]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return self.flat[place + np.repeat(self.begin[ids], size)].tobytes()


class ByteLevel:
    """Side A: ids of a byte-level vocabulary, and the bytes of each."""

    def __init__(self, path: str):
        self.encoder = encoder(path, False, True)
        # Byte-level vocabularies write a visible Latin-1 byte as itself, others from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in seen]
        byte = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}
        entries = {i: t for t, i in self.encoder.tokenizer.get_vocab(with_added_tokens=False).items()}
        size = self.encoder.tokenizer.get_vocab_size(with_added_tokens=True)
        known = lambda t: all(c in byte for c in t)
        self.entries = Entries(
            [bytes(byte[c] for c in entries[i]) if i in entries and known(entries[i]) else b"" for i in range(size)]
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encoder.encode([" " + t for t in texts])


class Pieces:
    """Side B: ids of a sentencepiece model, and the bytes of each."""

    def __init__(self, path: str):
        self.encoder = PieceEncoder(path)
        self.model = self.encoder.model
        entries = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            entries.append(
                bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            )
        self.entries = Entries(entries)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encoder.encode(texts)


@lru_cache(maxsize=2)
def side_a(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(maxsize=2)
def side_b(path: str) -> Pieces:
    return Pieces(path)


def slices(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of each side end, as indices after their last token.

    The ends of A, which ascend, are looked up in B's dictionary, so the common keys come out sorted.
    """
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    both = np.fromiter(map(at_b.get, ends_a, repeat(0)), np.int64, len(ends_a))  # 0 where only A ends
    common = np.flatnonzero(both)
    return common + 1, both[common]


def links_of(sizes_a: np.ndarray, sizes_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked places of both sides. A slice with one token on a side links it to all of the other; only
    slices with several on both are compared by byte ranges."""
    count_a, count_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
    begin_b = stop_b - count_b
    slice_of = np.repeat(np.arange(len(stop_a)), count_a)
    low, high = begin_b[slice_of], stop_b[slice_of]
    several = np.flatnonzero(((count_a > 1) & (count_b > 1))[slice_of])
    if len(several):
        ends_b = np.cumsum(sizes_b)
        end = np.cumsum(sizes_a)[several]
        low[several] = np.searchsorted(ends_b, end - sizes_a[several], side="right")
        high[several] = np.searchsorted(ends_b - sizes_b, end, side="left")
    n = high - low
    left = np.repeat(np.arange(len(n)), n)
    return left, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


@lru_cache(maxsize=1)
def _decimals(size: int) -> list[str]:
    """Every id with each of the marks that may follow it."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(size)]


def groups_text(a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray, size: int) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of both sides, group after group; ids are below ``size``."""
    count_a, count_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
    codes = np.empty(len(a) + len(b), np.int64)
    # A group's ids of A come after the ids of B of the groups before it; those of B follow them.
    codes[np.arange(len(a)) + np.repeat(stop_b - count_b, count_a)] = a
    codes[np.arange(len(b)) + np.repeat(stop_a, count_b)] = b
    codes[stop_a - 1 + stop_b - count_b] += size
    codes[stop_a + stop_b - 1] += 2 * size
    return "".join(map(_decimals(size).__getitem__, codes.tolist()))[:-1]


def align(text: str, a: np.ndarray, b: np.ndarray, one: ByteLevel, other: Pieces):
    """Group stops and linked places of both sides; None where a side does not give the text back."""
    whole = b" " + text.encode()
    if one.entries.joined(a) != whole or other.entries.joined(b) != whole:
        return None
    sizes_a, sizes_b = one.entries.sizes[a], other.entries.sizes[b]
    stop_a, stop_b = slices(np.cumsum(sizes_a).tolist(), np.cumsum(sizes_b).tolist())
    return stop_a, stop_b, links_of(sizes_a, sizes_b, stop_a, stop_b)


_ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Numbers of every document, and its distinct linked pairs (A id above ``B_BITS`` bits of the B
    id), ascending, with the number of their links."""

    def rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = side_a(path_a), side_b(path_b)
        size = max(len(one.entries.sizes), len(other.entries.sizes))
        for batch in found:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                texts = [t or "" for t in part.column("text").to_pylist()]
                numbers, names, pairs, times = [], [], [], []
                for text, a, b in zip(texts, one.encode(texts), other.encode(texts), strict=True):
                    made = align(text, a, b, one, other) if text else None
                    if made is None:
                        numbers.append((0, 0, 0, 0))
                        names.append("")
                        pairs.append(np.empty(0, np.int64))
                        times.append(np.empty(0, np.int32))
                        continue
                    stop_a, stop_b, (left, right) = made
                    linked = a.astype(np.int64)[left] << B_BITS | b[right]
                    own, n = np.unique(linked, return_counts=True)
                    numbers.append((len(a), len(b), len(stop_a), len(linked)))
                    names.append(hashlib.sha256(groups_text(a, b, stop_a, stop_b, size).encode()).hexdigest())
                    pairs.append(own)
                    times.append(n.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*numbers, strict=True)),
                     pa.array(names, pa.string()), pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    return docs.select("doc_id", "text").mapInArrow(rows, _ALIGNED)


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, count, best) of aligned documents: how many hold the pair linked, and whether no pair of
    the same A id is in more. An A id meets at most the vocabulary of side B."""
    counts = documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def token_links(documents: DataFrame) -> DataFrame:
    """(a_id, b_id, count, best): the corpus-wide table of linked ids, for use on its own."""
    return pair_counts(documents).select(
        F.shiftright("pair", B_BITS).cast("int").alias("a_id"),
        F.col("pair").bitwiseAND((1 << B_BITS) - 1).cast("int").alias("b_id"),
        "count",
        "best",
    )


def alignments(docs: DataFrame, path_a: str, path_b: str, max_bytes: int | None = None) -> DataFrame:
    """Per document (doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``max_bytes`` bounds the table of counts that is sent to every task.
    """
    documents = aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    documents = landed(documents, "aligned")
    counts = landed(pair_counts(documents), "pair-counts")
    linked = documents.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    bound = {} if max_bytes is None else {"max_bytes": max_bytes}
    met = lookup_join(linked, counts, ["pair"], "inner", **bound)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return documents.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )


def digest(docs: DataFrame) -> DataFrame:
    return alignments(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))
