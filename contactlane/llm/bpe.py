"""Byte-level BPE encoding and decoding with a given vocabulary file.

A word's parts are held in one contiguous array with the rank of each adjacent
pair beside it. The smallest rank (leftmost on ties) is found by a scan, the
boundary between the two parts is deleted, and the two neighbouring ranks are
refreshed. Words of more than ``SHORT`` bytes, where repeated scans would be
quadratic, keep the same order of merges with a heap over linked parts.

Spark deals out the documents; each task encodes its Arrow batches. A worker
process keeps the encodings of words it has met (at most ``CACHE_WORDS``) until
another operator's tasks let go of them.

Defined results: NULL texts encode as empty (no ids); an empty text gives an
empty array; NULL ids decode as empty; rows are independent, so repeated rows
give repeated results; columns other than the one added keep their values, and
an input column with the name of the added one is replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import store

SHORT = 96
CACHE_WORDS = 600_000
NO_RANK = 1 << 60
# Fixed value: the public pattern that splits a text into words before merging.
# White space is the Unicode property, as in the vocabulary's own library.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: visible Latin-1
    characters stand for themselves, the others for 256, 257, ... in turn."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encoder and decoder of one vocabulary file (tokenizer JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.token_bytes = {i: bytes(letters[c] for c in token) if all(c in letters for c in token)
                            else token.encode() for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.token_bytes |= {i: content.encode() for content, i in self.special.items()}
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank.setdefault((vocab[left], vocab[right]), len(self.merged))
            self.merged.append(vocab[left + right])
        self.words = regex.compile(WORDS)
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None
        self.cache: dict[str, bytes] = {}

    # -- one word -------------------------------------------------------------

    def merge_short(self, ids: list[int]) -> list[int]:
        rank, merged = self.rank, self.merged
        ranks = [rank.get(pair, NO_RANK) for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            ids[i] = merged[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), NO_RANK)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        rank, merged, n = self.rank, self.merged, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, pair in enumerate(zip(ids, ids[1:]))
                if (r := rank.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            # an entry is stale once either part has been merged away or changed
            if ids[i] < 0 or j >= n or rank.get((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = merged[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := rank.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (s, i))
            if (h := before[i]) >= 0 and (s := rank.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (s, h))
        return [t for t in ids if t >= 0]

    def word_ids(self, word: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in word]
        return self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)

    def _packed(self, word: str) -> bytes:
        out = np.array(self.word_ids(word.encode()), dtype="<i4").tobytes()
        if len(word) <= SHORT:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = out
        return out

    # -- texts ----------------------------------------------------------------

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if self.split_special is not None and any(s in text for s in self.special):
            return b"".join(
                np.int32(self.special[piece]).tobytes() if piece in self.special
                else self._plain(piece) for piece in self.split_special.split(text) if piece)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        get, pack = self.cache.get, self._packed
        return b"".join([get(w) or pack(w) for w in self.words.findall(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<i4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        of = self.token_bytes
        return b"".join([of[i] for i in ids if i in of]).decode("utf-8", errors="replace")


def codec(path: str) -> Codec:
    """The codec of a file, built once per process and kept while nothing else is."""
    return store.kept(("codec", path), lambda: Codec(path))


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array, drop: tuple[str, ...]) -> pa.RecordBatch:
    keep = [c for c in batch.schema.names if c != name and c not in drop]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [values], names=keep + [name])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
           keep_text: bool = True) -> DataFrame:
    """``df`` with the token ids of ``text`` in ``ids`` (array of int)."""
    drop = () if keep_text else (text,)
    fields = [f for f in df.schema.fields if f.name != ids and f.name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            packed = [own.encode_packed(t.as_py() or "") for t in batch.column(text)]
            ends = np.cumsum([0] + [len(p) // 4 for p in packed])
            flat = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
            yield _with_column(batch, ids, pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), flat), drop)

    store.ship(df.sparkSession)
    return df.mapInArrow(run, T.StructType(fields + [T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` in ``text``; ids not in the vocabulary are left out."""
    fields = [f for f in df.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = batch.column(ids)
            flat = rows.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([0] + [len(row) if row.is_valid else 0 for row in rows])
            texts = [own.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
            yield _with_column(batch, text, pa.array(texts, pa.string()), ())

    store.ship(df.sparkSession)
    return df.mapInArrow(run, T.StructType(fields + [T.StructField(text, T.StringType())]))
