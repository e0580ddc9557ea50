"""Word n-gram hashes of texts, for whole Arrow batches at a time.

Words are runs of bytes other than ASCII white space, A-Z read as a-z. A word's
hash is a polynomial over its bytes modulo 2^64 with random byte values and an
odd base, taken from running sums over a piece of the batch (texts are grouped
into pieces of about ``PIECE`` bytes; longer texts are cut at white space), then
mixed. It depends on the word alone. The hashes aren't meant to withstand
texts made to collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PIECE = 1 << 17
_RNG = np.random.default_rng(20240229)
_VALUE = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64)
_VALUE[ord("A"): ord("Z") + 1] = _VALUE[ord("a"): ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTORS = _RNG.integers(1, 1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0, 1, ...`` modulo 2^64, at least ``n`` of them."""
    own = _POWERS.get(base)
    if own is None or len(own) < n:
        own = np.full(max(n, 2 * PIECE), base, np.uint64)
        own[0] = 1
        np.cumprod(own, out=own)
        if n <= 2 * PIECE:
            _POWERS[base] = own
    return own[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` (bytes) and where each begins and ends; no
    word goes on over a place in ``breaks``."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    space = _SPACE[data]
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    breaks = breaks[(breaks > 0) & (breaks < len(data))]
    begins[breaks] = ~space[breaks]
    ends[breaks - 1] = ~space[breaks - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _powers(_BASE, len(data)), out=sums[1:])
    h = (sums[end] - sums[begin]) * _powers(_INVERSE, len(data))[begin]
    return _mixed(h + (end - begin).astype(np.uint64) * _FACTORS[-1]), begin, end


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``PIECE`` bytes together."""
    a = 0
    while a < len(offsets) - 1:
        b = int(np.searchsorted(offsets, offsets[a] + PIECE, side="right")) - 1
        b = max(b, a + 1)
        yield a, b
        a = b


def _long_text(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, begins and ends of one long text, cut at white space."""
    parts, a = [], 0
    while a < len(data):
        b = a + PIECE
        if b < len(data):
            step = 1 << 16
            while b < len(data):  # up to the next white space
                found = np.flatnonzero(_SPACE[data[b: b + step]])
                if len(found):
                    b += int(found[0])
                    break
                b += step
        hashes, begin, end = word_hashes(data[a:b], np.empty(0, np.int64))
        parts.append((hashes, begin + a, end + a))
        a = b
    return tuple(np.concatenate(p) for p in zip(*parts))


def batch_words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, tuple]]:
    """``(word hashes, words of each row, (bytes, begins, ends))`` for runs of rows
    in order; a NULL text has no words."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1] if n else \
        np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    for a, b in _pieces(offsets):
        own = data[offsets[a]: offsets[b]]
        if b == a + 1 and len(own) > PIECE:
            hashes, begin, end = _long_text(own)
            yield hashes, np.array([len(hashes)]), (own, begin, end)
            continue
        starts = offsets[a: b + 1] - offsets[a]
        hashes, begin, end = word_hashes(own, starts[:-1])
        yield hashes, np.diff(np.searchsorted(begin, starts)), (own, begin, end)


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (of the whole, if there are fewer)."""
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out += words[i: len(words) - n + 1 + i] * _FACTORS[i]
    return _mixed(out)


def batch_sets(column: pa.Array, n: int, word_level: np.ndarray | None = None
               ) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """For each row its sorted distinct n-gram hashes and, given a level for each
    bucket of word hashes, each n-gram's least word level."""
    empty = np.empty(0, np.uint64)
    for words, sizes, _ in batch_words(column):
        grams = _grams(words, n) if len(words) else empty
        level = None
        if word_level is not None and len(words):
            shift = np.uint64(64 - int(len(word_level)).bit_length() + 1)
            own = word_level[(words >> shift).astype(np.int64)]
            level = own[: len(grams)].copy()
            for i in range(1, min(n, len(words))):
                np.minimum(level, own[i: i + len(grams)], out=level)
        end = 0
        for size in sizes.tolist():
            begin, end = end, end + size
            if not size:
                yield empty, (np.empty(0, np.uint8) if word_level is not None else None)
                continue
            if size >= n:
                g, lv = grams[begin: end - n + 1], None if level is None else level[begin: end - n + 1]
            else:  # the whole sequence is its one n-gram
                g = _grams(words[begin:end], n)
                lv = None if level is None else own[begin:end].min(keepdims=True)
            if lv is None:
                g = np.sort(g)
                keep = np.ones(len(g), bool)
                keep[1:] = g[1:] != g[:-1]
                yield g[keep], None
            else:
                order = np.argsort(g)
                g, lv = g[order], lv[order]
                keep = np.ones(len(g), bool)
                keep[1:] = g[1:] != g[:-1]
                yield g[keep], lv[keep]


def set_key(grams: np.ndarray) -> int:
    """Key of a set: a hash of its sorted members."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))
