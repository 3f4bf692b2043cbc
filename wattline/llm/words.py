"""Words of a batch of texts as arrays: where they are, and a 64-bit hash of each."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text handled at once. A longer text makes a batch of its own.
BATCH_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLED = 64
#: Stands between texts; texts that contain it must not be cut by it.
GAP = 0


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finisher of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _values() -> np.ndarray:
    """A random number for every byte at each of the first ``_TABLED`` places of a word."""
    return _value(np.arange(_TABLED * 256, dtype=np.uint64))


def _value(code: np.ndarray) -> np.ndarray:
    return mixed(mixed(code + np.uint64(_BASE)) ^ np.uint64(0xD6E8FEB86659FD93))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, the same wherever they stand. Spans ascend and do not overlap.

    A byte's number depends on its place in the span through a mixing function, not through powers of
    a base, so that no family of words (such as Thue-Morse ones) collides by construction.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = (ends - starts).astype(np.int64)
    # The place of every byte since the last start. What lies between spans is not in any difference.
    head, upto = int(starts[0]), int(ends[-1])
    place = np.arange(head, upto, dtype=np.int32)
    place -= np.repeat(starts.astype(np.int32), np.diff(starts, append=upto))
    if size.max() <= _TABLED:
        np.minimum(place, _TABLED - 1, out=place)
        place <<= 8
        place |= data[head:upto]
        value = _values().take(place)
    else:
        code = (place.astype(np.int64) << 8) | data[head:upto]
        tabled = _values()[np.minimum(code, _TABLED * 256 - 1)]
        value = np.where(place < _TABLED, tabled, _value(code.astype(np.uint64)))
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    return mixed(sums[ends - head] - sums[starts - head] + size.astype(np.uint64) * np.uint64(_BASE))


def batches(sizes: list[int]) -> Iterator[slice]:
    """Consecutive slices of about ``BATCH_BYTES`` each."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > BATCH_BYTES:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a gap after each, and where each begins (and the last ends)."""
    data = np.frombuffer(b"".join(x for t in texts for x in (t, b"\0")), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.concatenate([[0], np.cumsum(sizes)])


# Words between ASCII white space: one flag per byte, and lower case for A-Z.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def plain_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space, A-Z in lower case.

    Gives the bytes in lower case, start and end of each word, and where the words of each text begin
    in that list (one more entry than texts).
    """
    raw, begins = joined(texts)
    white = _WHITE[raw]
    white[begins[1:] - 1] = True
    edge = np.diff(white.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(ends) and len(starts) and ends[0] <= starts[0]:
        ends = ends[1:]
    return _LOWER[raw], starts, ends, np.searchsorted(starts, begins)
