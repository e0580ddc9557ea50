"""Hard negatives by a secondary sort of pair scores.

For every anchor row the closest rows of its own label are its positives; each
positive opens a window of scores below its own, and the first rows of other
labels inside the window are its hard negatives. Closeness is the inner product
of whole-number vectors, higher first, ties to the smaller id.

The rows lie in blocks of bounded size; the anchors, a stated query set, pass
by each block in batches. A first pass keeps each block's best positives of an
anchor; with the final positives known, a second pass keeps of each block only
the first negatives of every window -- what a block leaves out is preceded, in
that window, by as many rows of the same block, so nothing is lost. What is kept
is packed into keys (anchor, descending score, kind, id) that
``repartitionAndSortWithinPartitions`` brings into order; an iterator then reads
each anchor's pairs as a stream: a positive opens its window, a negative goes to
the windows it falls into, and nothing but the open windows is held.

Defined results: rows without id or label, and vectors that are NULL or hold a
NULL or non-finite component, take no part; rows equal in id, label and vector
count once; an anchor's own row is any row with its id; rows of one id that
differ are rows of their own; only vectors of equal length are compared; scores
outside the 64-bit range are held at its ends; a positive whose score is below
zero has an empty window; empty tables give no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import store, vectors

BLOCK_ROWS = 8192
ANCHORS_AT_ONCE = 64
EXACT = float(1 << 53)
LIMIT = (1 << 63) - 1
OFFSET = 1 << 63
KEY = struct.Struct(">QQQBQ")  # anchor id, anchor row, descending score, kind, id
POSITIVE, NEGATIVE = 0, 1
FOUND = "anchor_id long, anchor_row long, vec_id long, score long"


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest whole score from ``low`` to ``high`` per cent of a positive's."""
    return -(-low * positive // 100), high * positive // 100


class Block:
    """Rows of one block and vector length, ordered by id."""

    def __init__(self, ids: list[int], labels: list[int], rows: list[np.ndarray]):
        order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
        self.ids = np.array(ids, dtype=np.int64)[order]
        self.labels = np.array(labels, dtype=np.int64)[order]
        self.whole = [rows[i] for i in order]
        self.rows = np.array(self.whole, dtype=float).reshape(len(order), -1)
        self.largest = float(np.abs(self.rows).max(initial=0.0))

    def scores(self, anchors: list[np.ndarray]) -> np.ndarray:
        """Exact inner products, one line for each anchor."""
        lines = np.array(anchors, dtype=float).reshape(len(anchors), -1)
        if self.largest * float(np.abs(lines).max(initial=0.0)) * lines.shape[1] < EXACT:
            return (lines @ self.rows.T).astype(np.int64)
        return np.array([[max(-LIMIT, min(LIMIT, sum(int(x) * int(y) for x, y in zip(a, r)))) for r in self.whole]
                         for a in anchors], dtype=np.int64)


def first_rows(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` allowed rows by descending score, ties by position."""
    at = np.flatnonzero(allowed)
    own = scores[at]
    if len(at) > k:
        kth = np.partition(own, len(own) - k)[len(own) - k]
        at, own = at[own >= kth], own[own >= kth]
    return at[np.argsort(-own, kind="stable")[:k]]


def _pass_by(rows: DataFrame, anchors: DataFrame, blocks: int, k: int, percent: tuple[int, int] | None) -> DataFrame:
    """Each block's candidates (``FOUND``): the first ``k`` rows of an anchor's label,
    or with ``percent`` the first ``k`` rows of other labels in each window of the
    anchor's positive scores (``opens``)."""
    none = F.lit(None).cast("array<long>")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1)))
    both = rows.select("block", F.lit(0).alias("kind"), "id", "row", "label", "vec", none.alias("opens")).unionByName(
        anchors.select(every_block.alias("block"), F.lit(1).alias("kind"), "id", "row", "label", "vec",
                       F.col("opens") if percent else none.alias("opens")))

    def candidates(block: Block, name: int, label: int, scores: np.ndarray, opens: list[int] | None) -> np.ndarray:
        same, other = block.labels == label, block.ids != name
        if percent is None:
            return first_rows(scores, same & other, k)
        found = [np.zeros(0, dtype=np.int64)]
        for low, high in {window_of(p, *percent) for p in opens}:
            if low <= high:
                found.append(first_rows(scores, ~same & other & (scores >= low) & (scores <= high), k))
        return np.unique(np.concatenate(found))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_block, held, blocks_here = None, {}, {}
        for batch in batches:
            number, kind, ids, row, labels = [batch.column(c).to_pylist() for c in
                                              ("block", "kind", "id", "row", "label")]
            vecs, opens = vectors.matrix(batch.column("vec")), batch.column("opens").to_pylist()
            waiting: dict[tuple[int, int], list[int]] = {}
            out: list[tuple] = []

            def answer() -> None:
                for (_, length), members in waiting.items():
                    block = blocks_here.get(length)
                    for start in range(0, len(members) if block else 0, ANCHORS_AT_ONCE):
                        some = members[start:start + ANCHORS_AT_ONCE]
                        for i, line in zip(some, block.scores([vecs[j] for j in some])):
                            own = candidates(block, ids[i], labels[i], line, opens[i])
                            out.append((np.full(len(own), ids[i]), np.full(len(own), row[i]), block.ids[own], line[own]))
                waiting.clear()

            for i in range(len(number)):
                if number[i] != at_block:
                    answer()
                    at_block, held, blocks_here = number[i], {}, {}
                if kind[i] == 0:
                    own = held.setdefault(len(vecs[i]), ([], [], []))
                    for values, value in zip(own, (ids[i], labels[i], vecs[i].copy())):
                        values.append(value)
                else:
                    if held:
                        blocks_here, held = {n: Block(*own) for n, own in held.items()}, {}
                    waiting.setdefault((at_block, len(vecs[i])), []).append(i)
            answer()
            columns = zip(*out) if out else [[np.zeros(0, dtype=np.int64)]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(c)).astype(np.int64)) for c in columns],
                                             names=["anchor_id", "anchor_row", "vec_id", "score"])

    store.ship(rows.sparkSession)
    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, FOUND)


def pack(kind: int, anchor: int, row: int, score: int, name: int) -> bytes:
    """Key of a pair: bytes in the order of anchor, descending score, kind and id."""
    return KEY.pack(anchor + OFFSET, row + OFFSET, LIMIT - score, kind, name + OFFSET)


def dealt_by(key: bytes) -> int:
    """Partition hash of a key: its anchor."""
    return zlib.crc32(key[:16])


def mined(keys: Iterable[tuple[bytes, None]], k: int, low: int, high: int) -> Iterator[tuple]:
    """The result's rows from keys in order."""
    anchor, open_windows = None, []
    for key, _ in keys:
        name, row, down, kind, other = KEY.unpack(key)
        score, other = LIMIT - down, other - OFFSET
        if (name, row) != anchor:
            anchor, open_windows = (name, row), []
        if kind == POSITIVE:
            open_windows.append([0, other, score, *window_of(score, low, high)])
            continue
        for w in open_windows:
            if w[0] < k and w[3] <= score <= w[4]:
                w[0] += 1
                yield name - OFFSET, w[1], w[0], other, w[2], score


def mine(table: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30,
         high: int = 90, key: str = "vec_id", label: str = "label", vec: str = "vec",
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows of ``table`` where ``is_anchor`` holds; ``vec`` is an
    array of whole numbers (long). A window reaches from ``low`` to ``high`` per
    cent of its positive's score (0 <= low <= high <= 100).
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("a window lies between 0 and 100 per cent of its positive's score")
    spark = table.sparkSession
    rows = store.stored(table.where(vectors.usable(F.col(vec)) & F.col(key).isNotNull() & F.col(label).isNotNull())
                        .select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                                F.col(vec).alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("asks")).distinct()
                        .withColumn("row", F.xxhash64("label", "vec")), "negatives-rows")
    blocks = -(-rows.count() // block_rows)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "row"), F.lit(max(blocks, 1))).cast("int"))
    anchors = rows.where("asks")
    best = W.partitionBy("anchor_id", "anchor_row").orderBy(F.desc("score"), "vec_id")
    near = store.stored(_pass_by(rows, anchors, blocks, positives, None).withColumn(
        "place", F.row_number().over(best)).where(F.col("place") <= positives).drop("place"), "negatives-positives")
    opens = near.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_row").alias("row")).agg(
        F.collect_set("score").alias("opens"))  # at most ``positives`` scores
    asking = anchors.join(opens, ["id", "row"])
    pairs = store.stored(
        near.withColumn("kind", F.lit(POSITIVE)).unionByName(
            _pass_by(rows, asking, blocks, negatives, (low, high)).withColumn("kind", F.lit(NEGATIVE))),
        "negatives-pairs")
    in_order = pairs.select("kind", "anchor_id", "anchor_row", "score", "vec_id").rdd.map(
        lambda r: (pack(*r), None)).repartitionAndSortWithinPartitions(
        int(spark.conf.get("spark.sql.shuffle.partitions")), dealt_by)
    return spark.createDataFrame(
        in_order.mapPartitions(lambda keys: mined(keys, negatives, low, high)),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        verifySchema=False)
