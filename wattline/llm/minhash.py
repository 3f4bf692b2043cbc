"""Near-duplicate documents by HyperMinHash.

Documents are sets of five-word shingles. A sketch keeps ``REGISTERS`` numbers: shingle hashes fall
into that many buckets, and of the least hash in a bucket a register holds its leading zeros and the
``MANTISSA`` bits that follow. Bands of registers are the keys of candidate search.

1. Documents with equal sets are one class.
2. In each band bucket every class is paired with the bucket's smallest class.
3. The sketches estimate similarity, corrected for registers that agree by chance; what is clearly
   below the threshold goes, all the rest is verified on full sets.
4. Links give components. Buckets that still hold several components take another head, twice; in
   what is left members meet all members, in cells of bounded size, where every pair across components
   that the sketches do not rule out is verified until the components have become one. So every pair
   that shares a bucket is verified, ruled out by its sketches, or in one component already, and only
   links leave a cell: no group is expanded into all pairs.

With ``BANDS`` bands of ``BAND`` registers a link of similarity 0.75 is missed with probability
``(1 - 0.75 ** BAND) ** BANDS``, about 5e-6, and the estimate's margin is five standard deviations.

Defined results: null and empty texts have an empty set and are linked with nothing; texts of fewer
than five words are one shingle, their whole sequence; repeated rows are equal documents; a null id
takes no part in links and is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.components import component_labels
from wattline.llm.shared import landed
from wattline.llm.words import batches, mixed, plain_words, span_hashes

SHINGLE, THRESHOLD = 5, 75  # words; hundredths
REGISTERS, MANTISSA = 128, 10
BAND, BANDS = 4, 32
#: Sketches of smaller sets are filled by few values; they are verified without an estimate.
ESTIMATED_FROM = 256
#: Classes per part of a large bucket, rounds with another head, and ids that may be sent to all tasks.
CELL, STAR_TURNS, SENT_IDS = 256, 2, 500_000

_BUCKET_BITS = REGISTERS.bit_length() - 1
_REST_BITS = 64 - _BUCKET_BITS


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [(t or "").encode() for t in texts]
    for part in batches([len(t) for t in raw]):
        data, starts, ends, cuts = plain_words(raw[part])
        words = span_hashes(data, starts, ends)
        # A rolling combination of neighbouring words; texts shorter than a shingle are combined below.
        mixes = [mixed(words + np.uint64(0x632BE59BD9B4E019 * (k + 1) & (1 << 64) - 1)) for k in range(SHINGLE)]
        full = max(0, len(words) - SHINGLE + 1)
        rolled = np.zeros(full, np.uint64)
        for k in range(SHINGLE):
            rolled += mixes[k][k : k + full]
        rolled = mixed(rolled)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                yield np.unique(rolled[a : b - SHINGLE + 1])
            elif b > a:
                short = sum(int(mixes[k][a + k]) for k in range(b - a)) + (b - a)
                yield mixed(np.array([short & (1 << 64) - 1], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def _borrow_order() -> np.ndarray:
    rng = np.random.default_rng(20)
    return np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)])


_EDGES = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(_REST_BITS)
_BORROW = _borrow_order()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a sorted set that is not empty. An empty bucket borrows the register of the first
    filled one in an order of its own, the same for all sets."""
    at = np.searchsorted(shingles, _EDGES)
    filled = at < len(shingles)
    least = shingles[np.minimum(at, len(shingles) - 1)]
    filled &= (least >> np.uint64(_REST_BITS)) == np.arange(REGISTERS, dtype=np.uint64)
    rest = (least << np.uint64(_BUCKET_BITS)) | np.uint64((1 << _BUCKET_BITS) - 1)
    # Leading zeros from the exponent of the upper bits, exact because 52 bits are converted.
    exponent = np.frexp((rest >> np.uint64(12)).astype(np.float64))[1]
    zeros = np.minimum(52 - exponent, 51)
    tail = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    registers = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | tail).astype(np.uint16)
    if not filled.all():
        source = _BORROW[np.arange(REGISTERS), np.argmax(filled[_BORROW], axis=1)]
        registers = np.where(filled, registers, registers[source])
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, of (rows, REGISTERS) sketches."""
    values = np.ascontiguousarray(registers).view(np.uint64)
    salt = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(values ^ mixed(salt)).view(np.int64)


def chance_agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that registers of two disjoint sets agree, from their sizes."""
    level = np.arange(0, 52)

    def at_level(n: np.ndarray) -> np.ndarray:
        rate = (n / REGISTERS)[:, None]
        return np.exp(-rate * 2.0 ** -(level + 1)) - np.exp(-rate * 2.0**-level)

    return (at_level(a) * at_level(b)).sum(axis=1) * 2.0**-MANTISSA


def estimate(agreeing: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from the number of agreeing registers and the set sizes."""
    chance = chance_agreement(a, b)
    return (agreeing / REGISTERS - chance) / (1 - chance)


def possible(agreeing: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that sizes and sketches do not rule out."""
    t = THRESHOLD / 100
    margin = 5 * np.sqrt(t * (1 - t) / REGISTERS)
    small, large = np.minimum(a, b), np.maximum(a, b)
    return (100 * small >= THRESHOLD * large) & (
        (small < ESTIMATED_FROM) | (estimate(agreeing, a, b) >= t - margin)
    )


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are at least as similar as the threshold, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= THRESHOLD * (len(a) + len(b) - both)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def text_key(text: str | None) -> bytes:
    """Tells texts apart; a null text is empty."""
    return hashlib.sha1((text or "").encode(), usedforsecurity=False).digest()


def text_key_of(text: str) -> Column:
    """:func:`text_key` of a column."""
    return F.unhex(F.sha1(F.coalesce(F.col(text), F.lit(""))))


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (16 bytes, null for empty sets), sketch and text_key (20 bytes) of
    each document."""

    def rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, keys, sketches, texts = [], [], [], part.column("text").to_pylist()
                for s in shingle_sets(texts):
                    sizes.append(len(s))
                    keys.append(hashlib.blake2b(s, digest_size=16).digest() if len(s) else None)
                    sketches.append(sketch(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(sketches, pa.binary()),
                        pa.array(map(text_key, texts), pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "sketch", "text_key"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, n_shingles long, set_key binary, sketch binary, text_key binary"
    )


def band_rows(classes: DataFrame) -> DataFrame:
    """(bucket, set_key) for every class and band."""

    def rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows:
                keys = band_keys(_matrix(batch.column("sketch")))
                names = batch.column("set_key").take(pa.array(np.repeat(np.arange(len(keys)), BANDS)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel(), pa.int64()), names], names=["bucket", "set_key"]
                )

    return classes.select("set_key", "sketch").mapInArrow(rows, "bucket long, set_key binary")


def not_ruled_out(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sketches leave possible."""

    def rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows:
                same = (_matrix(batch.column("sa")) == _matrix(batch.column("sb"))).sum(axis=1)
                keep = possible(same, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    own = classes.select("set_key", "n_shingles", "sketch")
    both = pairs.join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")
    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(rows, "a binary, b binary")


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_key, shingles) of the classes in ``wanted``, made again from the document (doc_id) that
    stands for each. Ids that are counted to be few are sent to every task, more are shuffled."""
    ids = wanted.select("doc_id").distinct()
    few = ids.count() <= SENT_IDS
    texts = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def sets(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                made = list(shingle_sets(batch.slice(at, 512).column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in made], pa.binary()),
                        pa.array([s.tobytes() for s in made], pa.binary()),
                    ],
                    names=["set_key", "shingles"],
                )

    return landed(texts.mapInArrow(sets, "set_key binary, shingles binary"), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are links, by their full sets."""

    def check(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            keep = [
                linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return both.mapInArrow(check, "a binary, b binary")


def linked_in_cell(
    keys: list[bytes], root: np.ndarray, size: np.ndarray, marks: np.ndarray, sets: list[np.ndarray],
    left: np.ndarray, right: np.ndarray, band: int,
) -> list[tuple[bytes, bytes]]:
    """Links that join the components of a cell: members ``left`` against members ``right``.

    Every pair across components that the sketches leave possible is verified, most similar first,
    until its two components have become one. A pair that shares several bands belongs to the first.
    """
    root, links = root.copy(), []
    for i in left.tolist():
        j = right[root[right] != root[i]]
        if not len(j):
            continue
        same = marks[j] == marks[i]
        first = same.reshape(len(j), BANDS, BAND).all(axis=2).argmax(axis=1)
        agreeing = same.sum(axis=1)
        open_ = (first == band) & possible(agreeing, np.full(len(j), size[i]), size[j])
        for k in j[open_][np.argsort(-agreeing[open_], kind="stable")].tolist():
            if root[k] != root[i] and linked(sets[i], sets[k]):
                links.append((max(keys[i], keys[k]), min(keys[i], keys[k])))
                root[root == root[k]] = root[i]
    return links


def links_across(members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) across components within the buckets given.

    ``members`` has (bucket, set_key, root, parts): a bucket of many classes is dealt over ``parts``
    parts, and each pair of parts is a cell of its own.
    """
    part = F.pmod(F.xxhash64("set_key", F.lit(1)), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1))
    described = classes.select("set_key", "n_shingles", "sketch").join(sets, "set_key")
    dealt = (
        members.withColumn("part", part.cast("int"))
        .join(described, "set_key")
        .withColumn("other", other)
        .select(
            "bucket",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "part", "set_key", "root", "n_shingles", "sketch", "shingles",
        )
    )

    def compare(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        part = table.column("part").to_numpy()
        roots = table.column("root").to_pylist()
        code = {r: i for i, r in enumerate(dict.fromkeys(roots))}
        links = []
        if len(code) > 1:
            marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16)
            marks = marks.reshape(-1, REGISTERS)
            bucket = table.column("bucket")[0].as_py()
            links = linked_in_cell(
                table.column("set_key").to_pylist(),
                np.array([code[r] for r in roots]),
                table.column("n_shingles").to_numpy(),
                marks,
                [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")],
                np.flatnonzero(part == low),
                np.flatnonzero(part == high),
                int(np.argmax(band_keys(marks[:1])[0] == bucket)),
            )
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return dealt.groupBy("bucket", "low", "high").applyInArrow(compare, "a binary, b binary")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after more links between their nodes."""
    ends = (
        links.join(roots.toDF("a", "ra"), "a", "left")
        .join(roots.toDF("b", "rb"), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    )
    lifted = landed(component_labels(ends), "lifted").toDF("root", "top")
    moved = roots.join(lifted, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    fresh = lifted.join(roots.select(F.col("node").alias("root")), "root", "left_anti")
    return landed(moved.union(fresh), "roots")


def in_mixed_buckets(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, set_key, root, members) of the buckets of three and more classes that still hold
    several components. In a bucket of two both have met."""
    placed = (
        shared.filter("n > 2")
        .join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
        .select("bucket", "set_key", F.coalesce("root", "set_key").alias("root"))
    )
    several = (
        placed.groupBy("bucket")
        .agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count(F.lit(1)).alias("members"))
        .filter("r <> s")
        .select("bucket", "members")
    )
    return landed(placed.join(several, "bucket"), "mixed-buckets")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): doc_id, n_shingles, component_id and kept."""
    return decisions(docs).select("doc_id", "n_shingles", "component_id", "kept")


def decisions(docs: DataFrame) -> DataFrame:
    """:func:`near_duplicates` with ``text_key`` and ``root``, which names the group where ids repeat;
    documents with empty sets are in no group."""
    described = landed(describe(docs), "sketches")
    classes = landed(
        described.filter("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    buckets = landed(band_rows(classes), "bands")
    heads = (
        buckets.groupBy("bucket")
        .agg(F.min("set_key").alias("head"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    shared = landed(buckets.join(heads, "bucket"), "shared-buckets")
    sets = class_sets(docs, shared.select("set_key").distinct().join(classes, "set_key"))
    stars = (
        shared.filter("set_key <> head")
        .select(F.col("set_key").alias("a"), F.col("head").alias("b"))
        .distinct()
    )
    links = landed(verified(landed(not_ruled_out(stars, classes), "stars"), sets), "links")
    roots = landed(component_labels(links), "roots")
    for turn in range(STAR_TURNS):
        # Another head for each bucket that still holds several components.
        open_ = in_mixed_buckets(shared, roots)
        order = F.struct(F.xxhash64("set_key", F.lit(turn)).alias("h"), "set_key", "root")
        heads = open_.groupBy("bucket").agg(F.min(order).alias("head"))
        pairs = open_.join(heads, "bucket").filter(F.col("root") != F.col("head.root"))
        stars = pairs.select(
            F.greatest("set_key", "head.set_key").alias("a"), F.least("set_key", "head.set_key").alias("b")
        ).distinct()
        found = landed(verified(landed(not_ruled_out(stars, classes), "stars"), sets), "links")
        roots = merged(roots, found)
    rest = in_mixed_buckets(shared, roots).withColumn("parts", F.ceil(F.col("members") / CELL))
    roots = merged(roots, landed(links_across(rest, classes, sets).distinct(), "across"))

    rooted = classes.select("set_key", F.col("doc_id").alias("first_id")).join(
        roots.withColumnRenamed("node", "set_key"), "set_key", "left"
    )
    rooted = rooted.withColumn("root", F.coalesce("root", "set_key"))
    named = rooted.join(
        rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root"
    ).select("set_key", "component_id", "root")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        described.select("doc_id", "n_shingles", "set_key", "text_key")
        .join(named, "set_key", "left")
        .select("doc_id", "n_shingles", found.alias("component_id"), "text_key", "root")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
