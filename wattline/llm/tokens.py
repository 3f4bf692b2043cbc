"""Token ids of whole texts, through the tokenizers library.

A vocabulary first cuts a text into words by a public pattern and then finds the ids of each word by
itself. Words recur, so the library gets each once per worker and its ids are kept by the hash of the
word. Texts are cut in batches, as arrays. Texts with characters outside printable ASCII and Latin-1,
whose classes differ between pattern engines, and texts that hold the string of an added token, go to
the library whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

from wattline.llm.words import GAP, batches, joined, span_hashes

_INNER_SPACE = re.compile("[^▁]▁")
_KNOWN_CHARS = re.compile(r"[\t\n\r -~¡-¬®-ÿ]*")
#: Words kept per worker (some 150 MB). Beyond, rare words are encoded again in each batch.
KEPT_WORDS = 1_000_000

# Classes of Latin-1 characters.
_GAP, _SPACE, _WHITE, _LETTER, _DIGIT, _SIGN = range(6)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[GAP, 32]] = _GAP, _SPACE
_CLASS[[9, 10, 13]] = _WHITE
_CLASS[[*range(65, 91), *range(97, 123), 170, 181, 186, *range(192, 215), *range(216, 247)]] = _LETTER
_CLASS[248:] = _LETTER
_CLASS[[*range(48, 58), 178, 179, 185, 188, 189, 190]] = _DIGIT
_LOWER = bytes(ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(256))


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _after_suffix(data: np.ndarray, apostrophes: np.ndarray) -> np.ndarray:
    """How many letters of ``'s 't 'm 'd 're 've 'll`` follow each apostrophe; 0 where none do."""
    one, two = data[apostrophes + 1], data[np.minimum(apostrophes + 2, len(data) - 1)]
    pair = one.astype(np.int64) * 256 + two
    double = np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])
    return np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(double, 2, 0))


def cut_words(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in Latin-1 texts that end with a gap.

    ``lower``: runs of letters, single digits and runs of signs, without white space. Otherwise runs
    of letters, digits or signs, each with a space before it, and what white space is left.
    """
    kind = _CLASS[data]
    before = np.concatenate([[_GAP], kind[:-1]]).astype(np.uint8)
    blank = (kind == _SPACE) | (kind == _WHITE)
    ink = kind >= _LETTER
    start = ink & (kind != before)
    if lower:
        start |= kind == _DIGIT
    else:
        # The space before a run belongs to it.
        led = start & (before == _SPACE)
        # White space that is left: a run of it, without its last character where ink follows.
        after_ink = np.concatenate([ink[1:], [False]])
        start |= blank & ((before >= _LETTER) | (before == _GAP))
        start |= blank & after_ink & ((before == _SPACE) | (before == _WHITE))
        start[np.flatnonzero(led)] = False
        start[np.flatnonzero(led) - 1] = True
    apostrophe = np.flatnonzero((data == 39) & start)
    if len(apostrophe):
        letters = _after_suffix(data, apostrophe)
        apostrophe, letters = apostrophe[letters > 0], letters[letters > 0]
        start[apostrophe + 1] = False
        nxt = apostrophe + 1 + letters
        start[nxt[kind[nxt] == _LETTER]] = True
    starts = np.flatnonzero(start)
    # A word ends where the next one starts, or at the first gap or dropped white space before that.
    stop = (kind == _GAP) | (blank if lower else False)
    edges = np.flatnonzero(start | stop)
    ends = edges[np.searchsorted(edges, starts, side="right")]
    return starts, ends


class KnownWords:
    """Ids of texts that are cut into words whose ids do not depend on each other: each word goes to
    the library once, its ids are kept by its hash."""

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.place: dict[int, int] = {}
        self.ids, self.size = np.empty(1 << 20, self.dtype), 0
        self.spans = np.zeros((1 << 18, 2), np.int64)  # begin and length by place

    def as_bytes(self, text: str) -> bytes:
        """A text that may be cut, in Latin-1, as its words are told apart."""
        raise NotImplementedError

    def cut(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word of such texts with a gap after each."""
        raise NotImplementedError

    def ids_of_words(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """The ids of all words, and how many each has."""
        raise NotImplementedError

    def is_known(self, text: str) -> bool:
        """Whether the text may be cut."""
        raise NotImplementedError

    def whole(self, text: str) -> np.ndarray:
        """The ids of a text from the library itself."""
        raise NotImplementedError

    def _add(self, hashes: list[int], words: list[bytes]) -> None:
        ids, sizes = self.ids_of_words(words) if words else ([], [])
        flat, sizes = np.array(ids, self.dtype), np.array(sizes, np.int64)
        while self.size + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        first = len(self.place)
        while first + len(sizes) > len(self.spans):
            self.spans = np.concatenate([self.spans, np.zeros_like(self.spans)])
        self.ids[self.size : self.size + len(flat)] = flat
        self.spans[first : first + len(sizes), 0] = self.size + np.cumsum(sizes) - sizes
        self.spans[first : first + len(sizes), 1] = sizes
        self.size += len(flat)
        self.place.update(zip(hashes, range(first, first + len(sizes)), strict=True))

    def _batch(self, texts: list[bytes]) -> list[np.ndarray]:
        data, begins = joined(texts)
        starts, ends = self.cut(data)
        words, first, which = np.unique(
            span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        hashes = words.tolist()
        if len(self.place) > KEPT_WORDS:
            self._forget()
        new = [i for i, h in enumerate(hashes) if h not in self.place]
        raw, at = data.tobytes(), first[new]
        spans = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
        self._add([hashes[i] for i in new], [raw[a:b] for a, b in spans])
        places = np.fromiter(map(self.place.__getitem__, hashes), np.int64, len(hashes))
        begin, size = self.spans[places[which]].T
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        cuts = total[np.searchsorted(starts, begins)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _forget(self) -> None:
        """Keep the words that came first; frequent ones do."""
        keep = KEPT_WORDS * 3 // 4
        self.size = int(self.spans[keep, 0])
        self.place = {h: i for h, i in self.place.items() if i < keep}

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of each text; null counts as empty."""
        texts = [t or "" for t in texts]
        out: list[np.ndarray | None] = [None] * len(texts)
        for part in batches([len(t) for t in texts]):
            known = []
            for i in range(part.start, part.stop):
                if self.is_known(texts[i]):
                    known.append(i)
                else:
                    out[i] = self.whole(texts[i])
            ids = self._batch([self.as_bytes(texts[i]) for i in known]) if known else []
            for i, x in zip(known, ids, strict=True):
                out[i] = x
        return out


class WordEncoder(KnownWords):
    """Encodes texts to packed little-endian ids. ``lower``: the vocabulary drops case and white
    space; otherwise it is a byte-level one that keeps both. ``plain_specials``: the strings of special
    tokens within a text are text like any other; otherwise they are those tokens, which is what the
    library does unless told."""

    def __init__(self, path: str, lower: bool, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Tokens that are matched after case is dropped are looked for in texts without case.
        self.added = [t.content for t in added if not t.normalized]
        self.added_lower = [t.content.lower() for t in added if t.normalized]
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lower = lower
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 65536
        super().__init__(np.dtype("<u4" if wide else "<u2"))
        # How byte-level vocabularies write bytes as characters: visible Latin-1 stands for itself.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in seen]
        self.letters = {b: 256 + i for i, b in enumerate(rest) if b != GAP}
        self.model = self.tokenizer.model

    def is_known(self, text: str) -> bool:
        if self.added_lower and any(a in text.lower() for a in self.added_lower):
            return False
        return bool(_KNOWN_CHARS.fullmatch(text)) and not any(a in text for a in self.added)

    def whole(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, self.dtype)

    def as_bytes(self, text: str) -> bytes:
        data = text.encode("latin-1")
        return data.translate(_LOWER) if self.lower else data

    def cut(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return cut_words(data, self.lower)

    def ids_of_words(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        letters = b"\0".join(words).decode("latin-1").encode().decode("latin-1")
        tokenize, ids, sizes = self.model.tokenize, [], []
        for word in letters.translate(self.letters).split("\0"):
            tokens = tokenize(word)
            sizes.append(len(tokens))
            ids += [t.id for t in tokens]
        return ids, sizes


class PieceEncoder(KnownWords):
    """Encodes texts with a sentencepiece BPE model, which puts a space before each. Where no piece has
    a space after another character, nothing is joined across such a place, and texts are cut there."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        super().__init__(np.dtype("<u4"))
        self.model = SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        chars = "".join(c for c in map(chr, range(256)) if c != " " and _KNOWN_CHARS.fullmatch(c))
        self.cuts = not any(_INNER_SPACE.search(p) for p in pieces) and all(
            self.model.normalize(t) == "▁" + t.replace(" ", "▁") for t in (chars, "a  b", " a ")
        )
        self.space = self.model.piece_to_id("▁")

    def is_known(self, text: str) -> bool:
        return self.cuts and bool(text) and bool(_KNOWN_CHARS.fullmatch(text))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), self.dtype)

    def as_bytes(self, text: str) -> bytes:
        return b" " + text.encode("latin-1")

    def cut(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = data == 32
        space[1:] &= ~space[:-1]  # of several spaces the first
        starts, edges = np.flatnonzero(space), np.flatnonzero(space | (data == GAP))
        return starts, edges[np.searchsorted(edges, starts, side="right")]

    def ids_of_words(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        # A word begins with its space, which the model adds; it gives nothing for that space alone.
        found = self.model.encode([w[1:].decode("latin-1") for w in words], num_threads=1)
        found = [ids or [self.space] for ids in found]
        return [i for ids in found for i in ids], [len(ids) for ids in found]


@lru_cache(maxsize=4)
def encoder(path: str, lower: bool, plain_specials: bool = False) -> WordEncoder:
    """The encoder of this worker."""
    return WordEncoder(path, lower, plain_specials)


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned checksum of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
