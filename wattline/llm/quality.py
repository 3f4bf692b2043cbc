"""Quality classification by co-training of two views.

One classifier sees the text (shares of characters and words), the other the page's metadata
(language, source, length). Both start from labelled documents. In each round each hands those of all
unlabelled documents that it is sure of to the other as pseudo-labels. Both are then calibrated on
labelled rows that were held out, and their log-odds are combined to score every document.

At most ``label_rows`` labelled documents, chosen by the hash of their ids, are gathered: some 80
numbers each on the driver. Unlabelled documents are not sampled. Their features are written once, 16
numbers a document, and each Newton step reads them all: tasks sum gradient and curvature over the
documents the other view is sure of, and the sums, whose number depends on the features alone, are
added up in Spark.

Defined results: a null or empty text has features of zero; null metadata is a category of its own;
labels that are null or name no document count for nothing, and of contradicting labels of one
document the worse counts; without labels of both kinds nothing can be learned: every probability is
then 1 and ``keep`` is true; repeated rows score alike, and each lends what it is sure of; null ids are
scored, but never train.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.shared import free_name, hashed_order, landed
from wattline.llm.words import batches, plain_words, span_hashes

LABEL_ROWS = 20_000
ROUNDS, SURE, KEEP_FROM = 3, 0.98, 0.5
HELD_OUT = 4  # one labelled document in so many calibrates
METADATA_SLOTS = 64
#: Newton steps of a round, each over all unlabelled documents, and the step that is small enough.
STEPS, NEAR = 6, 0.01

_UPPER, _DIGIT, _MARK, _STOP, _LETTER = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[ord(c) for c in "#$%&*@^~|\\<>{}[]=_+"]] = True
_STOP[[ord(c) for c in "!?"]] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
TEXT_FEATURES = (
    "upper", "digits", "marks", "shouts", "letters", "word_length", "distinct", "repeats",
    "marked_words", "lone_signs", "size", "line_length",
)


def _share(flags: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[begins[1:]] - total[begins[:-1]]) / np.maximum(sizes, 1)


def text_features(texts: list[str | None]) -> np.ndarray:
    """(texts, features): shares of kinds of characters and words over the whole text."""
    raw, out = [(t or "").encode() for t in texts], []
    for part in batches([len(t) for t in raw]):
        own = raw[part]
        joined = np.frombuffer(b"".join(t + b"\0" for t in own), np.uint8)
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        lower, starts, ends, cuts = plain_words(own)
        hashes, words = span_hashes(lower, starts, ends), np.diff(cuts)
        # Upper case beyond ASCII: the second byte of Latin-1 capitals.
        upper = _UPPER[joined] | (
            (np.concatenate([[0], joined[:-1]]) == 0xC3) & (joined >= 0x80) & (joined <= 0x9E)
        )
        ends_marked = (
            _MARK[joined[np.maximum(ends - 1, 0)]] | _STOP[joined[np.maximum(ends - 1, 0)]]
            if len(ends) else np.zeros(0, bool)
        )
        lone = (ends - starts == 1) & ~_LETTER[joined[starts]] if len(ends) else ends_marked
        same = np.concatenate([[False], hashes[1:] == hashes[:-1]])[: len(hashes)]
        owner = np.repeat(np.arange(len(own)), words)
        order = np.lexsort((hashes, owner))
        ho, oo = hashes[order], owner[order]
        fresh = np.ones(len(ho), bool)
        fresh[1:] = (ho[1:] != ho[:-1]) | (oo[1:] != oo[:-1])
        letters = _share(_LETTER[joined], begins, sizes)
        columns = [
            _share(upper, begins, sizes) / np.maximum(letters, 0.01),
            _share(_DIGIT[joined], begins, sizes),
            _share(_MARK[joined], begins, sizes),
            _share(_STOP[joined], begins, sizes),
            letters,
            np.minimum(sizes / np.maximum(words, 1), 40) / 40,
            # Distinct words fall with length by themselves; compare with what its root would give.
            np.bincount(oo[fresh], minlength=len(own)) / np.maximum(words, 1) ** 0.8,
            _share(same, cuts, words),
            _share(ends_marked, cuts, words),
            _share(lone, cuts, words),
            np.log1p(words) / 10,
            np.log1p(sizes / (1 + _share(joined == 10, begins, np.ones_like(sizes)))) / 10,
        ]
        out.append(np.stack(columns, 1))
    return np.concatenate(out) if out else np.zeros((0, len(TEXT_FEATURES)))


def metadata_numbers(lang: list, source: list, n_chars: list) -> np.ndarray:
    """(rows, 4): slots of language and source, size from the stated length, and whether it is null."""
    slot = lru_cache(maxsize=65_536)(lambda t: zlib.crc32(t.encode()) % METADATA_SLOTS)
    rows = [
        (slot(f"lang={a}"), slot(f"source={b}"), max(n or 0, 0), n is None)
        for a, b, n in zip(lang, source, n_chars, strict=True)
    ]
    out = np.array(rows, np.float64).reshape(-1, 4)
    out[:, 2] = np.log1p(out[:, 2]) / 10
    return out


def metadata_features(numbers: np.ndarray) -> np.ndarray:
    """(rows, features): a mark in each slot, and the size as a curve."""
    out, row = np.zeros((len(numbers), METADATA_SLOTS + 3)), np.arange(len(numbers))
    for c in (0, 1):
        out[row, numbers[:, c].astype(np.int64)] += 1
    size = numbers[:, 2]
    out[:, METADATA_SLOTS], out[:, METADATA_SLOTS + 1], out[:, METADATA_SLOTS + 2] = size, size * size, numbers[:, 3]
    return out


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


@dataclass
class Logistic:
    """Logistic regression with a small ridge, fitted by Newton steps on sums over rows."""

    weights: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    @classmethod
    def fitted(cls, x: np.ndarray, y: np.ndarray, steps: int = 25) -> Logistic:
        """Fitted to rows at hand, whose means and spreads scale the features from then on."""
        out = cls(np.zeros(x.shape[1] + 1), x.mean(0), x.std(0) + 1e-6)
        for _ in range(steps):
            if out.step(out.sums(x, y)) < 1e-6:
                break
        return out

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        # A feature that hardly varies among labelled rows must not outweigh all others elsewhere.
        return np.concatenate([np.ones((len(x), 1)), np.clip((x - self.mean) / self.spread, -20, 20)], 1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self._scaled(x) @ self.weights

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient and curvature over rows; those of parts of the rows add up."""
        z = self._scaled(x)
        p = _probability(z @ self.weights)
        curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z
        return np.concatenate([(y - p) @ z, curve.ravel()])

    def step(self, sums: np.ndarray, ridge: float = 1.0) -> float:
        """Move by a Newton step; gives how far."""
        n = len(self.weights)
        penalty = np.full(n, ridge)
        penalty[0] = 1e-6
        curve = sums[n:].reshape(n, n) + np.diag(penalty)
        move = np.clip(np.linalg.solve(curve, sums[:n] - penalty * self.weights), -5, 5)
        self.weights = self.weights + move
        return float(np.abs(move).max())


@dataclass
class QualityModel:
    """Both views, their calibrations, and the log-odds of a good document before any evidence."""

    views: tuple[Logistic, Logistic] | None
    scales: tuple[Logistic, Logistic] | None
    prior: float

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good by the text, by the metadata, and by both."""
        if self.views is None:
            return (np.ones(len(text)),) * 3
        odds = [
            scale.log_odds(view.log_odds(x)[:, None])
            for view, scale, x in zip(self.views, self.scales, (text, meta), strict=True)
        ]
        return _probability(odds[0]), _probability(odds[1]), _probability(odds[0] + odds[1] - self.prior)


def lent_sums(features: DataFrame, givers: list[Logistic], takers: list[Logistic], sure: float) -> list[np.ndarray]:
    """Sums of each taker over the rows (t, m) that the other view's giver is sure of."""
    sizes = [len(v.weights) * (len(v.weights) + 1) for v in takers]

    def add_up(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(n) for n in sizes]
        for batch in found:
            views = _stored(batch, "t"), metadata_features(_stored(batch, "m"))
            for i in (0, 1):
                p = _probability(givers[1 - i].log_odds(views[1 - i]))
                taken = (p >= sure) | (p <= 1 - sure)
                total[i] += takers[i].sums(views[i][taken], (p[taken] >= sure).astype(float))
        flat = np.concatenate(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["i", "v"])

    # As many rows as there are sums, whatever the number of documents.
    rows = features.select("t", "m").mapInArrow(add_up, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(sum(sizes))
    for r in rows:
        flat[r["i"]] = r["v"]
    return [flat[: sizes[0]], flat[sizes[0] :]]


def _stored(batch: pa.RecordBatch, name: str) -> np.ndarray:
    width = len(TEXT_FEATURES) if name == "t" else 4
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = lambda c: batch.column(c).to_pylist()
    return (
        text_features(column("text")),
        metadata_numbers(column("lang"), column("source"), column("n_chars")),
    )


def described(docs: DataFrame) -> DataFrame:
    """doc_id, and the numbers of the text (t) and of the metadata (m)."""

    def describe(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id")] + [pa.array(list(x), pa.list_(pa.float64())) for x in _numbers(part)],
                    names=["doc_id", "t", "m"],
                )

    numbers = T.ArrayType(T.DoubleType())
    kinds = T.StructType([docs.schema["doc_id"], T.StructField("t", numbers), T.StructField("m", numbers)])
    return docs.select(*_COLUMNS).mapInArrow(describe, kinds)


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_rows: int = LABEL_ROWS,
    rounds: int = ROUNDS,
    sure: float = SURE,
) -> QualityModel:
    """Fit on (doc_id, text, lang, source, n_chars): on a bounded sample of those that have a
    (doc_id, quality) label, and on all that have none."""
    nothing = QualityModel(None, None, 0.0)
    known = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
    )
    features = landed(described(docs.filter("doc_id is not null")), "quality-features")
    chosen = (
        known.join(features.select("doc_id"), "doc_id", "left_semi")
        .orderBy(hashed_order("doc_id"), "doc_id")
        .limit(label_rows)
    )
    # Repeated rows of a labelled id: one of them trains, that with the least numbers.
    sample = chosen.join(features, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("t", "m")).alias("x"))
    sample = sorted(sample.collect(), key=lambda r: r["doc_id"])
    label = np.array([r["label"] for r in sample], np.float64)
    if len(set(label)) < 2:
        return nothing
    views = [
        np.array([r["x"]["t"] for r in sample]),
        metadata_features(np.array([r["x"]["m"] for r in sample])),
    ]
    held = np.array([zlib.crc32(str(r["doc_id"]).encode()) % HELD_OUT == 0 for r in sample])
    train = ~held if len(set(label[~held])) == 2 else np.ones(len(label), bool)
    test = held if len(set(label[held])) == 2 else np.ones(len(label), bool)
    unlabelled = landed(features.join(known, "doc_id", "left_anti").select("t", "m"), "quality-unlabelled")
    models = [Logistic.fitted(x[train], label[train]) for x in views]
    for _ in range(rounds):
        givers = [replace(m) for m in models]
        for _ in range(STEPS):
            lent = lent_sums(unlabelled, givers, models, sure)
            moves = [
                m.step(m.sums(x[train], label[train]) + more)
                for m, x, more in zip(models, views, lent, strict=True)
            ]
            if max(moves) < NEAR:
                break
    scales = [
        Logistic.fitted(m.log_odds(x[test])[:, None], label[test]) for m, x in zip(models, views, strict=True)
    ]
    good = float(label.mean())
    return QualityModel(tuple(models), tuple(scales), float(np.log(good / (1 - good))))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All rows and columns of the documents, and ``p_text``, ``p_meta``, ``quality_score`` and
    ``keep``. Added columns get a leading underscore where names clash."""
    added = [free_name(docs.columns, n) for n in ("p_text", "p_meta", "quality_score", "keep")]
    kinds = [T.DoubleType(), T.DoubleType(), T.DoubleType(), T.BooleanType()]
    new_fields = [T.StructField(n, kind) for n, kind in zip(added, kinds, strict=True)]
    schema = T.StructType([*docs.schema.fields, *new_fields])

    def score(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                text, meta = _numbers(part)
                p_text, p_meta, both = model.score(text, metadata_features(meta))
                new = [pa.array(x) for x in (p_text, p_meta, both, both >= KEEP_FROM)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *new], names=[*part.schema.names, *added]
                )

    return docs.mapInArrow(score, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train_quality(docs, labels)
    scored = score_quality(docs.select(*_COLUMNS), model)
    return scored.select("doc_id", "p_text", "p_meta", "quality_score", "keep")
