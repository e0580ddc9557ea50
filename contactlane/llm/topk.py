"""Exact top-k by inner product of whole-number vectors: ball trees per shard.

Rows are dealt to cells by nearest pivot (a bounded set of rows) and cells are
cut by hash into shards of about ``SHARD_ROWS`` rows, so the size of a shard
stays the same at any size of the table. Each shard builds a ball tree. A batch
of queries goes down the tree where the bound of a ball, ``q . centre +
|q| * radius``, reaches a query's current k-th score; each query then takes the
leaves that are left best bound first, one, two, four, ... at a time, and stops
at the leaves below its k-th score.

Queries first search their own shard. The k-th score found there is shared: a
query is sent only to cells whose own ball reaches it, the ``WAVE`` best cells
first, then, with the k-th score raised by those, the ones that still reach it.

A shard's rows come before the queries in its task, so a task holds one shard's
rows and one batch of queries at a time.

Defined results: vectors that are NULL or hold a NULL or non-finite component
take no part; rows equal in id and vector count once; a query's own row is any
row with its id; only vectors of equal length are compared; ties go to the
smaller id; scores outside the 64-bit range are held at its ends; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import store, vectors

LEAF = 48
SHARD_ROWS = 4096
WAVE = 4
EXACT = float(1 << 53)
LIMIT = (1 << 63) - 1


class BallTree:
    """Balls over whole-number vectors (rows sorted by id)."""

    def __init__(self, ids: np.ndarray, vecs: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        # floats hold them exactly unless they are huge; then Python integers do
        self.rows = np.array([vecs[i] for i in order], dtype=float).reshape(len(order), -1)
        self.largest = float(np.abs(self.rows).max(initial=0.0))
        self.whole = [vecs[i] for i in order] if self.largest >= EXACT ** 0.5 else None
        self.members: list[np.ndarray | None] = []
        self.children: list[tuple[int, int] | None] = []
        centres: list[np.ndarray] = []
        radii: list[float] = []
        todo = [(np.arange(len(order)), -1, 0)]
        while todo:
            at, parent, side = todo.pop()
            own = self.rows[at]
            centre = own.mean(axis=0)
            far = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(centres)
            centres.append(centre)
            radii.append(float(far.max(initial=0.0)))
            self.members.append(None)
            self.children.append(None)
            if parent >= 0:
                pair = self.children[parent] or (-1, -1)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            if len(at) <= LEAF or radii[-1] == 0.0:
                self.members[node] = at
                continue
            a = own[int(far.argmax())]
            b = own[int(((own - a) ** 2).sum(axis=1).argmax())]
            lean = own @ (a - b)
            cut = np.argsort(lean, kind="stable")
            half = len(at) // 2
            todo.append((np.sort(at[cut[:half]]), node, 0))
            todo.append((np.sort(at[cut[half:]]), node, 1))
        self.centres = np.array(centres)
        self.radii = np.array(radii)

    def scores(self, at: np.ndarray, queries: np.ndarray, whole: list[np.ndarray]) -> np.ndarray:
        """Inner products (queries by rows) as 64-bit integers."""
        size = float(np.abs(queries).max(initial=0.0)) * self.largest * max(1, queries.shape[1])
        if size < EXACT:
            return (queries @ self.rows[at].T).astype(np.int64)
        rows = np.array([[int(x) for x in (self.whole[i] if self.whole else self.rows[i])] for i in at], dtype=object)
        asks = np.array([[int(x) for x in w] for w in whole], dtype=object)
        return np.minimum(np.maximum(asks @ rows.T, -LIMIT - 1), LIMIT).astype(np.int64)

    def search(self, queries: np.ndarray, own_ids: np.ndarray, floors: list[int | None], k: int,
               whole: list[np.ndarray]) -> Iterator[list[tuple[int, int]]]:
        """For each query up to ``k`` ``(score, id)`` that reach its floor."""
        best = _Best(own_ids, floors, k)
        norms = np.sqrt((queries ** 2).sum(axis=1))
        slack = norms * self.largest * np.sqrt(max(1, queries.shape[1]))
        asked, at_leaf, bounds = [], [], []
        alive = {0: np.arange(len(queries))}
        for node in range(len(self.centres)):  # a ball comes after the one it lies in
            at = alive.pop(node, None)
            if at is None:
                continue
            high = queries[at] @ self.centres[node] + norms[at] * self.radii[node]
            high += 1e-9 * (1.0 + np.abs(high) + slack[at])
            reaches = high >= best.least(at)
            at, high = at[reaches], high[reaches]
            if not at.size:
                continue
            if self.members[node] is None:
                for child in self.children[node]:
                    alive[child] = at
            else:
                asked.append(at)
                at_leaf.append(np.full(len(at), node))
                bounds.append(high)
        if asked:
            q, leaf, high = np.concatenate(asked), np.concatenate(at_leaf), np.concatenate(bounds)
            order = np.lexsort((leaf, -high, q))
            q, leaf, high = q[order], leaf[order], high[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            done, step = 0, 1
            while done <= place.max():
                now = np.flatnonzero((place >= done) & (place < done + step))
                now = now[high[now] >= best.least(q[now])]
                now = now[np.argsort(leaf[now], kind="stable")]
                nodes, first = np.unique(leaf[now], return_index=True)
                for node, own in zip(nodes, np.split(q[now], first[1:])):
                    at = self.members[node]
                    best.add(own, self.scores(at, queries[own], [whole[i] for i in own]), self.ids[at])
                done, step = done + step, 2 * step
        yield from best.lists()


class _Best:
    """The ``k`` best ``(score, id)`` of each query of a batch."""

    def __init__(self, own_ids: np.ndarray, floors: list[int | None], k: int):
        self.own, self.k = own_ids, k
        self.floor = np.array([-LIMIT - 1 if f is None else f for f in floors], dtype=np.int64)
        self.score = np.zeros((len(own_ids), k), dtype=np.int64)
        self.id = np.zeros((len(own_ids), k), dtype=np.int64)
        self.held = np.zeros((len(own_ids), k), dtype=bool)

    def least(self, at: np.ndarray) -> np.ndarray:
        """What a bound has to reach (as double; below all at the range's end)."""
        return np.where(self.floor[at] < -LIMIT, -np.inf, self.floor[at].astype(float))

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.floor[at][:, None]) & (ids != self.own[at][:, None])
        some = good.any(axis=1)
        at, good, scores = at[some], good[some], scores[some]
        held = np.concatenate([self.held[at], good], axis=1)
        score = np.concatenate([self.score[at], scores], axis=1)
        own = np.concatenate([self.id[at], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((own, ~score, ~held), axis=-1)[:, :self.k]  # ~x falls as x grows
        self.held[at], self.score[at], self.id[at] = (np.take_along_axis(x, order, axis=1) for x in (held, score, own))
        full = self.held[at, self.k - 1]
        self.floor[at[full]] = np.maximum(self.floor[at[full]], self.score[at[full], self.k - 1])

    def lists(self) -> Iterator[list[tuple[int, int]]]:
        for held, score, own in zip(self.held, self.score, self.id):
            yield list(zip(score[held].tolist(), own[held].tolist()))


def _search_shards(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score`` of the queries ``asked`` (``shard, id, vec,
    floor``) in the shards of ``index`` (``shard, id, vec``)."""
    both = index.select("shard", F.lit(0).alias("kind"), "id", "vec", F.lit(None).cast("long").alias("floor"))
    both = both.unionByName(asked.select("shard", F.lit(1).alias("kind"), "id", "vec", "floor"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, vecs, tree = None, [], [], None
        for batch in batches:
            shards, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own_ids, floors = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            rows = vectors.matrix(batch.column(3))
            waiting: list[int] = []
            found: list[tuple[int, int, int]] = []

            def answer() -> None:
                if waiting and tree is not None:
                    asks = np.array([rows[i] for i in waiting], dtype=float).reshape(len(waiting), -1)
                    hits = tree.search(asks, np.array([own_ids[i] for i in waiting]),
                                       [floors[i] for i in waiting], k, [rows[i] for i in waiting])
                    for i, own in zip(waiting, hits):
                        found.extend((own_ids[i], d, s) for s, d in own)
                waiting.clear()

            for i, kind in enumerate(kinds):
                if shards[i] != shard:
                    answer()
                    shard, ids, vecs, tree = shards[i], [], [], None
                if kind == 0:
                    ids.append(own_ids[i])
                    vecs.append(rows[i].copy())
                else:
                    if tree is None and ids:
                        tree = BallTree(np.array(ids), vecs)
                    waiting.append(i)
            answer()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[j] for f in found], pa.int64()) for j in range(3)],
                names=["query_id", "vec_id", "score"])

    store.ship(index.sparkSession)
    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(
        run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _cells(placed: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``dim, pivot, splits, radius, norm`` of the cells: in how many shards they
    are cut, the largest distance to the pivot and the largest norm."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = vectors.matrix(batch.column(2))
            out: dict[tuple[int, int], list[float]] = {}
            for row, dim, pivot in zip(rows, batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = row.astype(float)
                far = float(np.sqrt(((row - pivots[dim][pivot]) ** 2).sum())) if pivot >= 0 else 0.0
                cell = out.setdefault((dim, pivot), [0, 0.0, 0.0])
                cell[:] = cell[0] + 1, max(cell[1], far), max(cell[2], float(np.sqrt((row ** 2).sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in out], pa.int32()), pa.array([p for _, p in out], pa.int32()),
                 pa.array([c[0] for c in out.values()], pa.int64()),
                 pa.array([c[1] for c in out.values()], pa.float64()),
                 pa.array([c[2] for c in out.values()], pa.float64())], names=["dim", "pivot", "n", "radius", "norm"])

    found = placed.select("dim", "pivot", "vec").mapInArrow(
        run, "dim int, pivot int, n long, radius double, norm double")
    return found.groupBy("dim", "pivot").agg(F.ceil(F.sum("n") / SHARD_ROWS).cast("int").alias("splits"),
                                             F.max("radius").alias("radius"), F.max("norm").alias("norm"))


def _reached(asked: DataFrame, cells: dict[int, tuple[np.ndarray, ...]], begin: int, end: int | None) -> DataFrame:
    """``dim, pivot, id, vec, floor, home`` of each query of ``asked`` and each cell
    whose bound reaches its floor, of the query's cells from the ``begin``-th to
    before the ``end``-th by bound. ``cells`` has pivot numbers, centres, radii and
    norms for each length of vector; rows of a length without pivots lie in cell
    -1, which is always reached."""
    names = ["dim", "pivot", "id", "vec", "floor", "home"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = batch.column("floor").to_pylist()
            at, to = [], []
            for i, (dim, row) in enumerate(zip(batch.column("dim").to_pylist(), vectors.matrix(batch.column("vec")))):
                if dim not in cells:
                    if begin == 0:
                        at.append(i)
                        to.append(-1)
                    continue
                numbers, centres, radii, norms = cells[dim]
                row = row.astype(float)
                length = np.sqrt((row ** 2).sum())
                high = np.minimum(centres @ row + length * radii, length * norms)
                high += 1e-9 * (1.0 + np.abs(high) + length * norms)
                order = np.argsort(-high, kind="stable")[begin:end]
                # the least score of the range may stand for lower ones
                if floors[i] is not None and floors[i] >= -LIMIT:
                    order = order[high[order] >= floors[i]]
                at.extend([i] * len(order))
                to.extend(numbers[order].tolist())
            own = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own.column("dim"), pa.array(to, pa.int32())] + [own.column(c) for c in names[2:]], names=names)

    return asked.select("dim", "id", "vec", "floor", "home").mapInArrow(
        run, "dim int, pivot int, id long, vec array<long>, floor long, home string")


def top_k(table: DataFrame, is_query: Column, k: int, key: str = "vec_id", vec: str = "vec") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``table`` where
    ``is_query`` holds, the ``k`` other rows of largest inner product. ``vec``
    is an array of whole numbers (long)."""
    rows = store.stored(table.where(vectors.usable(F.col(vec)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vec).alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks")).distinct(), "topk-rows")
    pivots = vectors.pick_pivots(rows, "vec", max(1, -(-rows.count() // SHARD_ROWS)))
    placed = store.stored(vectors.with_pivot(rows, "vec", pivots), "topk-placed")
    cells = store.stored(_cells(placed, pivots), "topk-cells")
    index = placed.join(cells.select("dim", "pivot", "splits"), ["dim", "pivot"]).withColumn(
        "shard", F.concat_ws("-", "dim", "pivot", F.pmod(F.xxhash64("id", "vec"), F.col("splits"))))
    index = store.stored(index.select("shard", "dim", "id", "vec", "asks"), "topk-shards")
    balls: dict[int, list] = {}
    for c in cells.where("pivot >= 0").collect():  # at most as many as pivots
        balls.setdefault(c["dim"], []).append((c["pivot"], c["radius"], c["norm"]))
    reach = {d: (np.array([p for p, _, _ in own]), pivots[d][[p for p, _, _ in own]],
                 np.array([r for _, r, _ in own]), np.array([n for _, _, n in own])) for d, own in balls.items()}
    queries = index.where("asks").withColumnRenamed("shard", "home")
    found = store.stored(_search_shards(
        index, queries.withColumn("shard", F.col("home")).withColumn("floor", F.lit(None).cast("long")), k), "topk-home")
    for begin, end in ((0, WAVE), (WAVE, None)):
        floors = _best(found, k).groupBy(F.col("query_id").alias("id")).agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        sent = _reached(queries.join(floors, "id", "left"), reach, begin, end).join(
            cells.select("dim", "pivot", "splits"), ["dim", "pivot"])
        sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
        sent = sent.withColumn("shard", F.concat_ws("-", "dim", "pivot", "shard")).where("shard <> home")
        more = _search_shards(index, sent, k)
        found = found.union(more if end is None else store.stored(more, "topk-wave"))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def scaled(vec: Column, factor: int = 256) -> Column:
    """Components as whole numbers: ``floor(factor * x)``, x as double."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * factor))
