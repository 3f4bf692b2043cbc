"""Passages that repeat across documents, by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words of a document. A window repeats where its word sequence also
starts earlier: in a document with a smaller id, or before it in the same one. Words under such a
window are removed.

1. Suffixes are anchored: of the ``SPAN`` suffixes that start in a window's first words the one whose
   ``PREFIX`` first words hash least stands for it. Equal windows choose equal anchors, so only
   suffixes at anchors enter a tree (one word in about ``SPAN / 2``), each with the words before it
   that its windows need.
2. Anchored suffixes are counted by their prefix of ``PREFIX`` words. A prefix that occurs once can
   hold no repeat and goes.
3. Prefixes split the suffixes that are left into groups that fit a task's memory. In each group the
   sorted suffixes and their common prefixes are a suffix tree: nodes of string depth ``d`` are its
   runs of neighbours that share ``d`` words. The words before the anchors make a second tree. Windows
   that start ``o`` words before their anchor are equal where they share a node of depth
   ``WINDOW - o`` in the first tree and one of depth ``o`` in the second. Words are compared as they
   are; hashes only choose where they go.
4. Where more than ``GROUP_ROWS`` suffixes share a prefix, it grows to the whole window. Such a prefix
   is a deep node by itself, and its occurrences are reduced to the first one: within salted parts
   first, then among the first ones of the parts, so that no occurrence meets all others in one task.

Overlapping windows of a document merge into the maximal passages that it repeats.

Defined results: null and empty texts have no words; texts of fewer than ``WINDOW`` words lose none;
null ids come after all others; where an id is repeated, its texts are told apart by their hash and
ordered by it, and rows that are equal in id and text count as one document; an empty table gives an
empty result. Extra columns are ignored, whatever their names, and kept by :func:`without_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from wattline.llm.shared import free_name, landed
from wattline.llm.words import batches, joined, mixed, span_hashes

WINDOW = 20
#: Words of the shortest prefix, and suffixes that compete for a window; together at most WINDOW + 1.
PREFIX, SPAN = 9, 12
#: Anchored suffixes in a group that becomes a tree at once (some 2 MB of words).
GROUP_ROWS = 8_192

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: What tells documents apart, in their order.
KEY = ["last", "id", "tie"]


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes, start and end of each word, and where the words of each text begin."""
    raw, begins = joined(texts)
    white = _WHITE[raw]
    white[begins[1:] - 1] = True
    edge = np.diff(white.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return raw, starts, ends, np.searchsorted(starts, begins)


def prefix_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of ``PREFIX`` words from every word on that has so many after it."""
    full = max(0, len(words) - PREFIX + 1)
    total = np.zeros(full, np.uint64)
    for k in range(PREFIX):
        total += mixed(words[k : k + full] + np.uint64(0x632BE59BD9B4E019 * (k + 1) & (1 << 64) - 1))
    return mixed(total)


def least_ahead(values: np.ndarray) -> np.ndarray:
    """Place of the least of ``SPAN`` values from each on, the first one on a tie; places near the end
    look at what there is. Ranges of doubling width are combined."""
    best = np.arange(len(values))
    width = 1
    while width < SPAN:
        step = min(width, SPAN - width)
        ahead = best[step:]
        own = best[: len(ahead)]
        best = np.concatenate([np.where(values[ahead] < values[own], ahead, own), best[len(ahead) :]])
        width += step
    return best


def _anchored(texts: list[str | None]) -> Iterator[tuple]:
    """Per text: its number, bytes (a line break after each word), word starts and ends, and the
    prefix, the place, and the first and last window of each anchor."""
    raw = [(t or "").encode() for t in texts]
    for part in batches([len(t) for t in raw]):
        data, starts, ends, cuts = word_spans(raw[part])
        prefixes = prefix_hashes(span_hashes(data, starts, ends))
        lines = data.copy()
        lines[ends] = 10
        line = lines.tobytes()
        # A window's anchor lies within it, so what a window finds does not depend on its neighbours.
        anchor = least_ahead(prefixes)
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if b - a >= WINDOW:
                chosen = anchor[a : b - WINDOW + 1]
                first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
                last = np.append(first[1:], len(chosen)) - 1
                place = chosen[first]
                prefix = prefixes[place].view(np.int64)
                yield part.start + i, line, starts[a:b], ends[a:b], prefix, place - a, first, last


def key_of(docs: DataFrame) -> list[Column]:
    """What orders documents, as ``KEY`` names it: whether the id is null, the id, and a tie between
    texts of one id, which is 0 as long as no id is null or repeated."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("of_id"))
    unclear = ids.filter(F.col("doc_id").isNull() | (F.col("of_id") > 1))
    tie = F.lit(0).cast("long") if unclear.isEmpty() else F.xxhash64(F.coalesce("text", F.lit("")))
    number = F.col("doc_id").cast("long")
    return [number.isNull(), F.coalesce(number, F.lit(0)), tie]


_ANCHORS = "prefix long, last boolean, id long, tie long, place int"


def anchored_prefixes(rows: DataFrame) -> DataFrame:
    """Prefix hash and place of every anchored suffix."""

    def find(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            number, prefixes, places = [], [], []
            for i, *_, prefix, place, _, _ in _anchored(batch.column("text").to_pylist()):
                number.append(np.full(len(place), i))
                prefixes.append(prefix)
                places.append(place)
            if number:
                at = pa.array(np.concatenate(number))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(prefixes)), *(batch.column(c).take(at) for c in KEY),
                     pa.array(np.concatenate(places).astype(np.int32))],
                    names=["prefix", *KEY, "place"],
                )

    return rows.mapInArrow(find, _ANCHORS)


_SUFFIXES = (
    "prefix long, uses long, last boolean, id long, tie long, place int, "
    "first int, windows int, words binary"
)


def shared_suffixes(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Anchored suffixes whose prefix is in ``shared`` (prefix, uses): their place, first window and
    number of windows, and the words from the first window to the end of the last, a line each.

    Only numbers meet in the join with the prefixes; texts meet what is left of their own anchors,
    which for one document is never more than its words.
    """
    kept = anchored_prefixes(rows).join(shared, "prefix")
    chosen = F.sort_array(F.collect_set(F.struct("place", "uses")))
    own = kept.groupBy(*KEY).agg(chosen.alias("kept"))

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            wanted = batch.column("kept")
            edge = wanted.offsets.to_numpy()
            wanted_place, wanted_uses = (wanted.values.field(c).to_numpy() for c in ("place", "uses"))
            number, numbers, words = [], [], []
            for i, line, starts, ends, prefix, place, first, last in _anchored(batch.column("text").to_pylist()):
                at = wanted_place[edge[i] : edge[i + 1]]
                k = np.searchsorted(place, at)
                a, n = first[k], last[k] - first[k] + 1
                b = a + n + WINDOW - 2
                own = [line[x:y] for x, y in zip(starts[a].tolist(), ends[b].tolist(), strict=True)]
                wide = np.concatenate([[0], np.cumsum(starts[1:] - ends[:-1] > 1)])
                for j in np.flatnonzero(wide[b] > wide[a]).tolist():  # more white space between words
                    spans = zip(starts[a[j] : b[j] + 1].tolist(), ends[a[j] : b[j] + 1].tolist(), strict=True)
                    own[j] = b"\n".join(line[x:y] for x, y in spans)
                number.append(np.full(len(k), i))
                numbers.append((prefix[k], wanted_uses[edge[i] : edge[i + 1]], at, a, n))
                words += own
            if number:
                at = pa.array(np.concatenate(number))
                columns = [pa.array(np.concatenate(c)) for c in zip(*numbers, strict=True)]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                prefixes, uses, *rest = (c.cast(k) for c, k in zip(columns, kinds, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [prefixes, uses, *(batch.column(c).take(at) for c in KEY), *rest, pa.array(words, pa.binary())],
                    names=["prefix", "uses", *KEY, "place", "first", "windows", "words"],
                )

    return rows.join(own, KEY).select(*KEY, "text", "kept").mapInArrow(cut, _SUFFIXES)


def nodes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix tree of rows of word numbers: their order, and how many words each has in common with
    the one before it. Nodes of depth ``d`` are runs whose common words are ``d`` or more."""
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return order, np.concatenate([[0], common])


def at_depth(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row at a depth."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def repeats_in_group(words: list[bytes], place: np.ndarray, first: np.ndarray, windows: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a group (row number) and starts of their windows that also start earlier.

    ``key`` numbers the documents in their order; ``words`` are the words around each anchor.
    """
    pieces = [w.split(b"\n") for w in words]
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    every = list(chain.from_iterable(pieces))
    numbers = {w: i for i, w in enumerate(dict.fromkeys(every))}
    flat = np.fromiter(map(numbers.__getitem__, every), np.int64, len(every))
    begin = np.cumsum(size) - size
    middle = place - first  # words before the anchor
    right = np.arange(WINDOW)[None, :] + middle[:, None]
    left = middle[:, None] - 1 - np.arange(SPAN - 1)[None, :]
    take = lambda at: np.where((at >= 0) & (at < size[:, None]), flat[np.clip(begin[:, None] + at, 0, len(flat) - 1)], -1)
    after, before = nodes(take(right)), nodes(take(left))
    rows, starts = [], []
    for o in range(SPAN):
        # Windows that start o words before their anchor.
        own = np.flatnonzero((o <= middle) & (middle - o < windows))
        if len(own) < 2:
            continue
        a, b = at_depth(*after, WINDOW - o)[own], at_depth(*before, o)[own]
        start = place[own] - o
        later, _ = later_occurrences((a, b), key[own], start)
        rows.append(own[later])
        starts.append(start[later])
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(starts)


def later_occurrences(
    classes: tuple[np.ndarray, ...], key: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of occurrences with equal classes all but the first ones (by document and start), and the first of
    each class."""
    order = np.lexsort((start, key, *classes[::-1]))
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in classes:
        fresh[1:] |= c[order][1:] != c[order][:-1]
    lead = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    later = (key[order] != key[lead]) | (start[order] != start[lead])
    return order[later], order[fresh]


_STARTS = "last boolean, id long, tie long, starts array<int>"


def _document_numbers(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """A number per row that orders the documents."""
    columns = [rows.column(c).to_numpy(zero_copy_only=False) for c in KEY]
    order = np.lexsort(columns[::-1])
    fresh = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(fresh)])[: len(order)]
    return number


def _grouped_starts(table: pa.Table | pa.RecordBatch, row: np.ndarray, start: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """Starts gathered per document."""
    order = np.lexsort((start, key[row]))
    row, start = row[order], start[order]
    edge = np.flatnonzero(np.concatenate([[True], key[row][1:] != key[row][:-1]])) if len(row) else np.empty(0, np.int64)
    at = pa.array(row[edge], pa.int64())
    offsets = pa.array(np.append(edge, len(row)), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(start, pa.int32()))
    return pa.RecordBatch.from_arrays([*(table.column(c).take(at) for c in KEY), lists], names=[*KEY, "starts"])


def starts_in_trees(suffixes: DataFrame, groups: int) -> DataFrame:
    """Starts of repeated windows, per document and group."""

    def grow(table: pa.Table) -> pa.Table:
        rows = table.combine_chunks().to_batches()[0]
        key = _document_numbers(rows)
        numbers = [rows.column(c).to_numpy().astype(np.int64) for c in ("place", "first", "windows")]
        found = repeats_in_group(rows.column("words").to_pylist(), *numbers, key)
        return pa.Table.from_batches([_grouped_starts(rows, *found, key)])

    group = F.pmod(F.xxhash64("prefix"), F.lit(groups)).alias("group")
    return (
        suffixes.select(group, *KEY, "place", "first", "windows", "words")
        .groupBy("group")
        .applyInArrow(grow, _STARTS)
    )


def starts_at_full_depth(suffixes: DataFrame, group_rows: int) -> DataFrame:
    """Starts of repeated windows whose prefix has grown to the whole window."""

    def windows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Occurrences of a batch meet here: all but the first are repeats, and only the first goes on.
        for batch in found:
            number, starts, names = [], [], []
            firsts, words = batch.column("first").to_pylist(), batch.column("words").to_pylist()
            for i, n in enumerate(batch.column("windows").to_pylist()):
                own = words[i].split(b"\n")
                number += [i] * n
                starts += range(firsts[i], firsts[i] + n)
                names += [b"\n".join(own[k : k + WINDOW]) for k in range(n)]
            codes = {w: i for i, w in enumerate(dict.fromkeys(names))}
            code = np.fromiter(map(codes.__getitem__, names), np.int64, len(names))
            row, start, key = np.array(number, np.int64), np.array(starts, np.int64), _document_numbers(batch)
            later, lead = later_occurrences((code,), key[row], start)
            repeats = _grouped_starts(batch, row[later], start[later], key)
            if len(repeats):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(repeats), pa.binary()), pa.nulls(len(repeats), pa.int64()), *repeats.columns],
                    names=["window", "uses", *KEY, "starts"],
                )
            at = pa.array(row[lead])
            digests = [hashlib.blake2b(names[j], digest_size=16).digest() for j in lead.tolist()]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(lead) + 1), pa.int32()), pa.array(start[lead], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), *(batch.column(c).take(at) for c in ("uses", *KEY)), lists],
                names=["window", "uses", *KEY, "starts"],
            )

    kinds = "window binary, uses long, last boolean, id long, tie long, starts array<int>"
    rows = landed(suffixes.select("uses", *KEY, "first", "windows", "words").mapInArrow(windows, kinds), "full-depth")
    firsts = rows.filter("window is not null").withColumn("start", F.element_at("starts", 1))
    parts = F.ceil(F.col("uses") * SPAN / group_rows)
    dealt = firsts.withColumn("part", F.pmod(F.xxhash64(*KEY, "start"), parts))
    place = [*KEY, "start"]
    rank = lambda *by: F.dense_rank().over(Window.partitionBy(*by).orderBy(*place))
    within = landed(dealt.withColumn("rank", rank("window", "part")).drop("part", "uses"), "full-depth")
    across = within.filter("rank = 1").withColumn("rank", rank("window"))
    found = rows.filter("window is null").select(*KEY, "starts")
    for part in (within, across):
        found = found.union(part.filter("rank > 1").select(*KEY, "starts"))
    return found


def repeated_starts(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Starts of windows that also start earlier: one row per document (``KEY``) that has any."""
    uses = anchored_prefixes(rows).groupBy("prefix").agg(F.count(F.lit(1)).alias("uses"))
    shared = landed(uses.filter("uses > 1"), "prefixes")
    suffixes = landed(shared_suffixes(rows, shared), "suffixes")
    light, heavy = F.col("uses") <= group_rows, F.col("uses") > group_rows
    total = shared.filter(light).agg(F.sum("uses")).first()[0] or 0
    found = starts_in_trees(suffixes.filter(light), total // group_rows + 1)
    if not shared.filter(heavy).isEmpty():
        found = found.union(starts_at_full_depth(suffixes.filter(heavy), group_rows))
    return landed(found, "starts").groupBy(*KEY).agg(F.flatten(F.collect_list("starts")).alias("starts"))


def _kept(count: int, starts: list[int] | None) -> np.ndarray:
    """Which of a document's words stay."""
    if not starts:
        return np.ones(count, bool)
    at = np.asarray(starts)
    edge = np.bincount(at, minlength=count + 1) - np.bincount(at + WINDOW, minlength=count + 1)
    return np.cumsum(edge)[:count] == 0


def without_repeats(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_text (the kept words, a space between two) and passages
    (first word and end of every maximal run of removed words)."""
    added = "n_words long, n_removed long, kept_text string, passages array<struct<first:int,end:int>>"
    added = StructType.fromDDL(added)
    names = [free_name(docs.columns, f.name) for f in added]
    inner = [free_name(docs.columns + names, f"of_{k}") for k in (*KEY, "starts")]
    key = key_of(docs)
    rows = docs.select(*(c.alias(k) for c, k in zip(key, KEY, strict=True)), "text")
    found = repeated_starts(rows, group_rows).toDF(*inner)
    keyed = docs.withColumns(dict(zip(inner[:-1], key, strict=True)))
    met = keyed.join(found, inner[:-1], "left").select(*docs.columns, inner[-1])
    kinds = docs.schema
    schema = StructType([*kinds, *(StructField(n, f.dataType) for n, f in zip(names, added, strict=True))])
    text = [c.lower() for c in docs.columns].index("text")

    def remove(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            counts, removed, texts, passages = [], [], [], []
            lists = batch.column(batch.num_columns - 1).to_pylist()
            raw = [(t or "").encode() for t in batch.column(text).to_pylist()]
            for part in batches([len(t) for t in raw]):
                data, starts, ends, cuts = word_spans(raw[part])
                line = data.tobytes()
                for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                    keep = _kept(b - a, lists[part.start + i])
                    at = np.flatnonzero(keep) + a
                    own = [line[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                    edge = np.diff(np.concatenate([[1], keep.astype(np.int8), [1]]))
                    runs = zip(np.flatnonzero(edge == -1).tolist(), np.flatnonzero(edge == 1).tolist(), strict=True)
                    counts.append(b - a)
                    removed.append(b - a - len(at))
                    texts.append(b" ".join(own).decode())
                    passages.append([{"first": x, "end": y} for x, y in runs])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(texts, pa.string()), pa.array(passages, kind)],
                names=[*kinds.fieldNames(), *names],
            )

    return met.mapInArrow(remove, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Rows of the contract: doc_id, n_words, n_removed and the hash of what is kept."""
    found = without_repeats(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
