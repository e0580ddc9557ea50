"""Packing documents into token sequences of bounded length, best fit decreasing.

A document's token ids, closed by an end id, are first cut into full windows;
each of those is a sequence of its own. What remains of every document (its
tail, shorter than a window) is packed by size, largest first, each into the
open window with the least room that holds it. The open windows hang in a
segment tree indexed by remaining room, so the tightest one is found in
logarithmic time.

Sequences are padded up to the window, except those whose length is a power of
two. Windows left with more than ``slack`` ids of padding are mended within
their batch: the emptiest is dealt out to fill the gaps of the fullest (this is
the only place where a tail is cut), and the last one is cut into sequences of
powers of two. Padding is thus at most ``slack`` ids a window.

Spark deals out the documents; nothing is shuffled. Each task packs batches of at
most ``batch_tokens`` ids (and one document), so its memory doesn't depend on
the size of the table, a hot source or the number of equal documents.

Defined results: NULL and empty texts are the end id alone; NULL and repeated
keys are carried along, every row is packed on its own; an empty table gives no
rows; columns other than key and text are not read. Sequence ids are unique and
follow the partitions of the input, not consecutive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import bpe, store

BATCH_TOKENS = 1 << 22
OUT_ROWS = 2048
# Fixed value: the split pattern of bpe.WORDS in the spelling that tiktoken's
# engine reads, without backtracking.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++"
           r"|\s++$|\s+(?!\S)|\s")

Piece = tuple[int, int, int]  # tail, first id in the document, number of ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Token ids of a text by a byte-level BPE file (tokenizer JSON).

    Where the file's merges give ids in the order of their ranks, as tiktoken
    presumes, that library encodes; else the codec of operator 9.
    """
    own = bpe.codec(path)
    in_order = all(i == 256 + rank for rank, i in enumerate(own.merged))
    if not in_order or sorted(own.byte_ids) != list(range(256)):
        return lambda text: np.frombuffer(own.encode_packed(text), dtype="<u4")
    ranks = {token: i for i, token in own.token_bytes.items() if i not in own.special.values()}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=own.special)
    return lambda text: fast.encode_to_numpy(text, allowed_special="all")


class OpenWindows:
    """Segment tree over remaining room: a leaf holds the windows with that much
    room, a node tells whether any window hangs below it."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.leaves + room
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least room of at least ``need``: its room
        and number."""
        node, filled = self.leaves + need, self.filled
        if not filled[node]:
            while node > 1 and (node & 1 or not filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            filled[node] = 0
            node >>= 1
            while node and not (filled[2 * node] or filled[2 * node + 1]):
                filled[node] = 0
                node >>= 1
        return room, window


def best_fit(lengths: list[int], window: int) -> list[list[int]]:
    """Best fit decreasing of ``lengths`` (1 to ``window``): the items of each window."""
    packed: list[list[int]] = []
    room_left = OpenWindows(window)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[item]
        found = room_left.take_tightest(n)
        if found is None:
            room, at = window, len(packed)
            packed.append([])
        else:
            room, at = found
        packed[at].append(item)
        if room > n:
            room_left.add(room - n, at)
    return packed


def no_padding(fill: int, window: int, slack: int) -> bool:
    """Whether a sequence of ``fill`` ids gets at most ``slack`` ids of padding."""
    return window - fill <= slack or fill & (fill - 1) == 0


def mend(loose: list[list[Piece]], window: int, slack: int) -> list[list[Piece]]:
    """Close windows that would be padded: the emptiest ones are dealt out to the
    gaps of the fullest; the last is cut into powers of two."""
    def fill_of(pieces: list[Piece]) -> int:
        return sum(n for _, _, n in pieces)

    rows = sorted(([fill_of(p), list(p)] for p in loose), key=lambda x: -x[0])
    done: list[list[Piece]] = []
    first, last = 0, len(rows) - 1
    while first < last:
        fill, pieces = rows[first]
        if window - fill <= slack:
            done.append(pieces)
            first += 1
            continue
        donor = rows[last]
        item, start, n = donor[1].pop()
        moved = min(n, window - fill)
        pieces.append((item, start, moved))
        rows[first][0] += moved
        donor[0] -= moved
        if moved < n:
            donor[1].append((item, start + moved, n - moved))
        if not donor[1]:
            last -= 1
    for fill, pieces in rows[first:last + 1]:
        while pieces and not no_padding(fill, window, slack):
            size, part = 1 << (fill.bit_length() - 1), []
            fill -= size
            while size:
                item, start, n = pieces.pop()
                own = min(n, size)
                part.append((item, start, own))
                size -= own
                if own < n:
                    pieces.append((item, start + own, n - own))
            done.append(part)
        if pieces:
            done.append(pieces)
    return done


def pack_tails(lengths: list[int], starts: list[int], window: int, slack: int) -> list[list[Piece]]:
    """Windows of one batch of tails."""
    whole = [[(i, starts[i], lengths[i]) for i in items] for items in best_fit(lengths, window)]
    fits = [no_padding(sum(n for _, _, n in pieces), window, slack) for pieces in whole]
    return ([pieces for pieces, ok in zip(whole, fits) if ok]
            + mend([pieces for pieces, ok in zip(whole, fits) if not ok], window, slack))


def sequences(df: DataFrame, path: str, window: int = 1024, end_id: int = 0, slack: int = 8,
              key: str = "doc_id", text: str = "text", batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """One row for each piece of a document: ``key``, ``start`` (ids of the
    document before it), ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset`` (its place in the sequence)."""
    key_field = T.StructField(key, df.schema[key].dataType)
    schema = T.StructType([key_field] + [T.StructField(n, t) for n, t in (
        ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()),
        ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([end_id], dtype="<u4")
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        tails: list[tuple] = []
        held = 0
        types = None

        def out(least: int) -> Iterator[pa.RecordBatch]:
            while len(rows) > least:
                own, rows[:] = rows[:OUT_ROWS], rows[OUT_ROWS:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*own), types)], names=schema.names)

        def packed() -> None:
            nonlocal number
            for pieces in pack_tails([len(t[2]) for t in tails], [t[1] for t in tails], window, slack):
                offset = 0
                for item, start, n in pieces:
                    name, first, ids, total = tails[item]
                    rows.append((name, start, n, ids[start - first:start - first + n].tobytes(), total,
                                 number, offset))
                    offset += n
                number += 1
            tails.clear()

        for batch in batches:
            if types is None:
                types = [batch.column(0).type, pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * 3
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(words.as_py() or ""), end]).astype("<u4", copy=False)
                whole = len(ids) - len(ids) % window
                for start in range(0, whole, window):
                    rows.append((name, start, window, ids[start:start + window].tobytes(), len(ids), number, 0))
                    number += 1
                    if len(rows) >= OUT_ROWS:
                        yield from out(OUT_ROWS - 1)
                if whole < len(ids):
                    tails.append((name, whole, ids[whole:].copy(), len(ids)))
                    held += len(ids) - whole
                if held >= batch_tokens:
                    packed()
                    held = 0
                    yield from out(0)
        if types is not None:
            packed()
            yield from out(0)

    store.ship(df.sparkSession)
    return df.select(key, text).mapInArrow(run, schema)
