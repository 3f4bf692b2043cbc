"""Token ids in files, compressed by grammar (Re-Pair), in ascending order of documents.

Documents are range-partitioned by id; each task writes files of at most ``FILE_TOKENS`` ids. Within a
file frequent pairs of neighbouring symbols are replaced by new symbols, round after round until no
pair occurs ``LEAST_USES`` times; a round takes the ``ROUND_RULES`` most frequent pairs instead of one.
Pairs never span two documents, so any document can be decoded by itself.

File format, little-endian: ``MAGIC``, then 6 unsigned 64-bit numbers (documents, rules, symbols, id
bytes, first rule's symbol, tokens), then sections: document ids (8 bytes each) and their null marks
(1 byte), tokens per document (8), symbols per document (8), rules as pairs (4 + 4), tokens a rule
expands to (4), symbols (as many bits each as the largest needs).

Files are written by one attempt of one task each and listed only by tasks that ended, so lost
executors and repeated tasks leave no trace in the result.

Defined results: a null text is empty and has the end id alone; null ids come first; rows with equal
ids keep all their rows, ordered by text; an empty table gives no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.shared import landed, read_range, write_file
from wattline.llm.tokens import encoder
from wattline.workspace import new_folder

MAGIC = b"REPAIR02"
FILE_TOKENS = 2_000_000
#: Rules that one round may add, and how often a pair must occur to become a rule. Rounds go on until
#: no pair does.
ROUND_RULES, LEAST_USES = 16384, 8
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def compress(ids: np.ndarray, sizes: np.ndarray, base: int):
    """Replace pairs until none occurs ``LEAST_USES`` times. ``ids`` of all documents, ``sizes`` per
    document, ``base`` above all ids.

    Gives symbols, symbols per document, and rules: rule ``i`` is symbol ``base + i``, a pair of ids or
    earlier rules.
    """
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    # Where a pair begins that may be frequent. One that is not can only become so by symbols that come
    # later; since rules of earlier rounds may come again, all pairs are counted once more at the end.
    alive, counted = ~last, True
    rules, known, number = [np.empty((0, 2), np.uint32)], np.empty(0, np.uint64), np.empty(0, np.int64)
    top = base
    while True:
        at = np.flatnonzero(alive)
        pairs = symbols[at].astype(np.uint64) << _HALF | symbols[at + 1]
        ordered = np.sort(pairs)
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[: len(ordered)]
        uses = np.diff(np.append(edge, len(ordered)))
        often = np.flatnonzero(uses >= LEAST_USES)
        if not len(often):
            if counted:
                break
            alive, counted = ~last, True
            continue
        counted = False
        frequent = ordered[edge[often]]
        maybe = _among(frequent, symbols, at, top)
        alive[at[~maybe]] = False
        at, pairs = at[maybe], pairs[maybe]
        chosen = frequent
        if len(often) > ROUND_RULES:
            chosen = np.sort(frequent[np.argsort(-uses[often], kind="stable")[:ROUND_RULES]])
            maybe = _among(chosen, symbols, at, top)
            at, pairs = at[maybe], pairs[maybe]
        rule = np.minimum(np.searchsorted(chosen, pairs), len(chosen) - 1)
        hit = chosen[rule] == pairs
        at, rule = at[hit], rule[hit]
        # Of overlapping pairs, every second one from the left of the overlap on.
        fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        even = (np.arange(len(at)) - begin) % 2 == 0
        at, rule = at[even], rule[even]
        # A pair that overlaps kept from its rule in an earlier round has that rule still.
        symbol = np.full(len(chosen), -1, np.int64)
        if len(known):
            place = np.minimum(np.searchsorted(known, chosen), len(known) - 1)
            symbol = np.where(known[place] == chosen, number[place], -1)
        new = np.flatnonzero((symbol < 0) & (np.bincount(rule, minlength=len(chosen)) > 0))
        symbol[new] = top + np.arange(len(new))
        rules.append(np.stack([chosen[new] >> _HALF, chosen[new] & _LOW], 1).astype(np.uint32))
        known, number = np.concatenate([known, chosen[new]]), np.concatenate([number, symbol[new]])
        order = np.argsort(known)
        known, number = known[order], number[order]
        top += len(new)
        symbols[at] = symbol[rule]
        last[at] = last[at + 1]
        alive[at] = ~last[at]
        before = at[at > 0] - 1
        alive[before] = ~last[before]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last, alive = symbols[keep], last[keep], alive[keep]
    spans = np.zeros(len(sizes), np.int64)
    ends = np.flatnonzero(last) + 1
    spans[sizes > 0] = np.diff(ends, prepend=0)
    return symbols, spans, np.concatenate(rules).astype(np.uint32)


def _among(pairs: np.ndarray, symbols: np.ndarray, at: np.ndarray, top: int) -> np.ndarray:
    """Which positions may hold one of the pairs, by its two halves: quick, and never too few."""
    left, right = np.zeros(top, bool), np.zeros(top, bool)
    left[pairs >> _HALF] = True
    right[pairs & _LOW] = True
    return left[symbols[at]] & right[symbols[at + 1]]


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for."""
    sizes = np.ones(base + len(rules), np.uint32)
    for i, (a, b) in enumerate(rules.tolist()):
        sizes[base + i] = sizes[a] + sizes[b]
    return sizes[base:]


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for: rules are written out once, then copied to their places."""
    begin = np.cumsum(lengths, dtype=np.int64) - lengths
    flat = np.empty(int(lengths.sum()), np.uint32)
    for i, pair in enumerate(rules.tolist()):
        at = begin[i]
        for s in pair:
            if s < base:
                flat[at] = s
                at += 1
            else:
                j = s - base
                flat[at : at + lengths[j]] = flat[begin[j] : begin[j] + lengths[j]]
                at += lengths[j]
    is_rule = symbols >= base
    rule = np.where(is_rule, symbols, base).astype(np.int64) - base
    if not len(rules):
        return symbols.astype(np.uint32)
    size = np.where(is_rule, lengths[rule], 1).astype(np.int64)
    place = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint32)
    out[place[~is_rule]] = symbols[~is_rule]
    big = np.flatnonzero(is_rule)
    n = size[big]
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(place[big], n) + inner] = flat[np.repeat(begin[rule[big]], n) + inner]
    return out


def packed_bits(symbols: np.ndarray, width: int) -> bytes:
    """Each symbol in ``width`` bits, highest first, one behind the other."""
    bits = np.unpackbits(symbols.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :]).tobytes()


def unpacked_bits(raw: bytes, skip: int, count: int, width: int) -> np.ndarray:
    """``count`` symbols that begin after ``skip`` bits."""
    bits = np.zeros((count, 32), np.uint8)
    flat = np.unpackbits(np.frombuffer(raw, np.uint8))[skip : skip + count * width]
    bits[:, 32 - width :] = flat.reshape(count, width)
    return np.packbits(bits, axis=1).view(">u4").reshape(count).astype(np.uint32)


def file_bytes(doc_ids: list[int | None], docs: list[np.ndarray], base: int) -> list[bytes]:
    """One file, as sections."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    ids = np.concatenate([*docs, np.empty(0, np.uint16)])
    symbols, spans, rules = compress(ids, sizes, base)
    width = (base + len(rules)).bit_length()
    head = np.array([len(docs), len(rules), len(symbols), width, base, len(ids)], "<u8")
    return [
        MAGIC + head.tobytes(),
        np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        sizes.astype("<i8").tobytes(),
        spans.astype("<i8").tobytes(),
        rules.astype("<u4").tobytes(),
        expansion_lengths(rules, base).astype("<u4").tobytes(),
        packed_bits(symbols, width),
    ]


class TokenFile:
    """Reads a file of this format by byte ranges: the directory first, documents on demand."""

    def __init__(self, uri: str):
        self.uri = uri
        head = read_range(uri, 0, 56)
        if head[:8] != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        docs, rules, self.symbols, self.width, self.base, self.tokens = np.frombuffer(
            head, "<u8", 6, 8
        ).tolist()
        self.symbols_at = 56 + 25 * docs + 12 * rules
        rest, at = read_range(uri, 56, self.symbols_at - 56), 0

        def section(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(rest, kind, count, at)
            at += out.nbytes
            return out

        ids, nulls = section("<i8", docs), section("u1", docs)
        self.doc_ids = [None if z else x for x, z in zip(ids.tolist(), nulls.tolist(), strict=True)]
        self.sizes, self.spans = section("<i8", docs), section("<i8", docs)
        self.rules = section("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = section("<u4", rules)

    def _expand(self, first: int, count: int) -> np.ndarray:
        begin, end = first * self.width, (first + count) * self.width
        raw = read_range(self.uri, self.symbols_at + begin // 8, -(-end // 8) - begin // 8)
        symbols = unpacked_bits(raw, begin % 8, count, self.width)
        return expand(symbols, self.rules, self.lengths, self.base)

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, from its own bytes alone."""
        return self._expand(int(self.spans[:i].sum()), int(self.spans[i]))

    def all_ids(self) -> np.ndarray:
        return self._expand(0, self.symbols)


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, lower: bool, end_id: int
) -> DataFrame:
    """Encode (doc_id, text) documents and write them; one row per file, in order of documents:
    shard, part, uri, documents, tokens, and ``first_token``, the ids in all files before."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, part, held, names, total = TaskContext.get().partitionId(), 0, [], [], 0
        encode = encoder(vocabulary, lower)
        base = encode.tokenizer.get_vocab_size(with_added_tokens=True)
        end = encode.dtype.type(end_id)

        def flush() -> pa.RecordBatch:
            uri, _ = write_file(folder, f"{shard:06d}-{part:04d}", file_bytes(names, held, base))
            row = {"shard": shard, "part": part, "uri": uri, "documents": len(held), "tokens": total}
            return pa.RecordBatch.from_pylist([row], schema=listed)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for name, ids in zip(
                    rows.column("doc_id").to_pylist(),
                    encode.encode(rows.column("text").to_pylist()),
                    strict=True,
                ):
                    held.append(np.append(ids, end))
                    names.append(name)
                    total += len(ids) + 1
                if total >= FILE_TOKENS:
                    yield flush()
                    part, held, names, total = part + 1, [], [], 0
        if held:
            yield flush()

    listed = pa.schema(
        [("shard", pa.int32()), ("part", pa.int32()), ("uri", pa.string())]
        + [("documents", pa.int64()), ("tokens", pa.int64())]
    )
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    files = ordered.mapInArrow(write, "shard int, part int, uri string, documents long, tokens long")
    # One row per file: a sum over all of them stays small where sums over documents would not.
    so_far = F.sum("tokens").over(Window.orderBy("shard", "part"))
    return landed(files, "token-files").withColumn("first_token", so_far - F.col("tokens"))


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the listed files: doc_id, start, n_tokens, ids_crc32, ids (packed, 4 bytes)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["uri"])
                ids = file.all_ids().astype("<u4")
                ends = np.cumsum(file.sizes)
                starts = ends - file.sizes
                for at in range(0, len(ends), 1024):
                    own = [
                        ids[a:b].tobytes()
                        for a, b in zip(starts[at : at + 1024], ends[at : at + 1024], strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids[at : at + 1024], pa.int64()),
                            pa.array(starts[at : at + 1024] + row["first_token"], pa.int64()),
                            pa.array(file.sizes[at : at + 1024], pa.int64()),
                            pa.array(map(zlib.crc32, own), pa.int64()),
                            pa.array(own, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                    )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    spread = files.select("uri", "first_token").repartition(max(1, files.count()))
    return spread.mapInArrow(read, schema)


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    from wattline.llm.tokens import vocabulary_path

    folder = new_folder(spark, "tokens")
    files = write_token_files(docs, folder, vocabulary_path("byte_bpe_50k.json"), False, 2)
    return read_token_files(files).drop("ids")
