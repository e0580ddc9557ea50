"""Mixing documents from overlapping sources to target weights.

Documents are aggregated by membership pattern (the set of sources they belong
to). A min-cost flow routes the patterns' words to the sources' quotas; the
k-th repetition of a pattern's words costs k a word, so repeats are convex and
spread over patterns. Each pattern then gives its flow: whole passes over its
documents, and a last partial pass over the first documents in a seeded order.

Only one row per pattern and one per source reach the driver; more than
``MAX_PATTERNS`` of either is an error, never a truncation.

Defined results: NULL or wordless texts have size 0 and take 0 words; a NULL
source is a source of its own, last in order; a document without any source
(empty list) takes 0 words; repeated rows are documents of their own; the order
of documents depends on the id, the size and the seed alone; an empty table
gives an empty mix; input columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_PATTERNS = 50_000
REPEATS = 3
SEED = "mix-1"
# Seeded order: a hash of the id; this many leading hex digits make its bucket.
BUCKET_HEX = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def share_targets(sizes: Sequence[int], weights: Sequence[float], most: int = REPEATS) -> list[float]:
    """Split the total size by weight; a target stops at ``most`` times its
    source's size and the excess goes to the others by weight, until none is
    above."""
    caps = [most * s for s in sizes]
    capped: set[int] = set()
    while True:
        left = sum(sizes) - sum(caps[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        unit = left / weight if weight else 0.0
        above = {i for i, w in enumerate(weights) if i not in capped and w * unit > caps[i]}
        if not above:
            return [float(caps[i]) if i in capped else w * unit for i, w in enumerate(weights)]
        capped |= above


class Flow:
    """Min-cost max-flow, primal-dual: shortest distances by cost, then blocking
    flows over the arcs on shortest paths. Costs are small integers, so there
    are few distinct distances."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[int] = []

    def add(self, u: int, v: int, capacity: int, cost: int) -> int:
        for a, b, room, c in ((u, v, capacity, cost), (v, u, 0, -cost)):
            self.arcs[a].append(len(self.to))
            self.to.append(b)
            self.left.append(room)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, s: int) -> list[float]:
        dist = [math.inf] * len(self.arcs)
        dist[s] = 0
        queue, waiting = deque([s]), {s}
        while queue:
            u = queue.popleft()
            waiting.discard(u)
            for e in self.arcs[u]:
                if self.left[e] > 0 and dist[u] + self.cost[e] < dist[self.to[e]]:
                    dist[self.to[e]] = dist[u] + self.cost[e]
                    if self.to[e] not in waiting:
                        waiting.add(self.to[e])
                        queue.append(self.to[e])
        return dist

    def run(self, s: int, t: int) -> None:
        while (dist := self._distances(s))[t] < math.inf:
            while self._push_shortest(s, t, dist):
                pass

    def _push_shortest(self, s: int, t: int, dist: list[float]) -> bool:
        """One blocking flow over arcs of shortest paths, layered by hops."""
        hops = {s: 0}
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in self.arcs[u]:
                v = self.to[e]
                if self.left[e] > 0 and v not in hops and dist[v] == dist[u] + self.cost[e]:
                    hops[v] = hops[u] + 1
                    queue.append(v)
        if t not in hops:
            return False
        nxt = [0] * len(self.arcs)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                room = min(self.left[e] for e in path)
                for e in path:
                    self.left[e] -= room
                    self.left[e ^ 1] += room
                path, u = [], s
                continue
            while nxt[u] < len(self.arcs[u]):
                e = self.arcs[u][nxt[u]]
                v = self.to[e]
                if (self.left[e] > 0 and hops.get(v) == hops[u] + 1
                        and dist[v] == dist[u] + self.cost[e]):
                    break
                nxt[u] += 1
            else:
                if u == s:
                    return True
                u = self.to[path.pop() ^ 1]
                nxt[u] += 1
                continue
            path.append(e)
            u = v


def route(patterns: Sequence[tuple[tuple[str | None, ...], int]], quotas: dict[str | None, int],
          most: int = REPEATS) -> list[int]:
    """Words taken from each pattern ``(sources, size)`` to fill the quotas."""
    sources = {s: i for i, s in enumerate(quotas)}
    start, sink = 0, 1 + len(patterns) + len(sources)
    flow = Flow(sink + 1)
    passes = []
    for p, (members, size) in enumerate(patterns):
        passes.append([flow.add(start, 1 + p, size, k) for k in range(1, most + 1)])
        for m in members:
            flow.add(1 + p, 1 + len(patterns) + sources[m], most * size, 0)
    for s, i in sources.items():
        flow.add(1 + len(patterns) + i, sink, quotas[s], 0)
    flow.run(start, sink)
    return [sum(flow.left[e ^ 1] for e in own) for own in passes]


def bounded_rows(df: DataFrame, what: str) -> list:
    rows = df.limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} distinct {what}: coarsen the sources first")
    return rows


def repeated(taken: DataFrame, size: str = "size") -> DataFrame:
    """Whole rows as often as the mix takes them (a part counts from half up)."""
    times = F.when(F.col(size) > 0, F.round(F.col("taken") / F.col(size)).cast("int")).otherwise(0)
    return taken.withColumn("__times", times).where("__times > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).drop("__times", "__copy")


def source_sizes(docs: DataFrame, source: str = "source", size: str = "size") -> list[tuple[str | None, int]]:
    """``(source, size)`` by code point of the source, NULL last."""
    rows = bounded_rows(docs.groupBy(source).agg(F.sum(size).alias("n")), "sources")
    return sorted(((r[0], int(r["n"] or 0)) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))


def mix(docs: DataFrame, quotas: dict[str | None, int], sources: str = "sources", key: str = "doc_id",
        size: str = "size", most: int = REPEATS, seed: str = SEED, slim: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``taken``: the words that the mix takes from each row.

    ``sources`` is an array of the sources that a row belongs to; ``quotas``
    maps each source to the words wanted. A row is taken ``taken / size`` times;
    at most one row of a pattern is taken in part. ``slim``, the same rows with
    these columns alone, spares counting the sizes of wide rows once more.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c != "taken"]

    def ordered(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({
            "__pattern": F.to_json(F.array_sort(F.array_distinct(F.col(sources)))),
            "__order": F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))),
        })
        return rows.withColumn("__bucket", F.conv(F.substring("__order", 1, BUCKET_HEX), 16, 10).cast("int"))

    work = ordered(docs.select(*own))
    counted = ordered(slim if slim is not None else docs.select(sources, key, size))
    by_pattern = bounded_rows(counted.groupBy("__pattern").agg(
        F.sum(size).alias("n"), F.first(F.array_distinct(F.col(sources))).alias("members")), "patterns")
    patterns = [(tuple(r["members"] or ()), int(r["n"] or 0)) for r in by_pattern]
    wanted = {s: quotas.get(s, 0) for members, _ in patterns for s in members}
    flows = route(patterns, wanted, most)
    plan = spark.createDataFrame(
        [(r["__pattern"], f // n if n else 0, f - f // n * n if n else 0)
         for r, (_, n), f in zip(by_pattern, patterns, flows)],
        "__pattern string, __passes long, __rest long")
    # Where the partial pass ends: the bucket in which the running size passes the rest.
    totals = counted.groupBy("__pattern", "__bucket").agg(F.sum(size).alias("n"))
    upto = W.partitionBy("__pattern").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    ends = totals.withColumn("__before", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(
        plan, "__pattern").where((F.col("__before") <= F.col("__rest"))
                                 & (F.col("__rest") < F.col("__before") + F.col("n")))
    ends = ends.select("__pattern", "__passes", "__rest", F.col("__bucket").alias("__end"), "__before")
    # At most one row for each of MAX_PATTERNS patterns: small enough for every task.
    # A pattern without an end row has no words at all; its rows take nothing.
    ends = F.broadcast(ends)
    placed = work.join(ends, work["__pattern"].eqNullSafe(ends["__pattern"]), "left").drop(ends["__pattern"])
    size_col = F.coalesce(F.col(size), F.lit(0)).cast("long")
    passes = F.coalesce("__passes", F.lit(0))
    inner = placed.where(F.col("__end").isNull() | (F.col("__bucket") != F.col("__end"))).withColumn(
        "taken", size_col * (passes + F.when(F.col("__bucket") < F.col("__end"), 1).otherwise(0)))
    before = W.partitionBy("__pattern").orderBy("__order", key, size).rowsBetween(W.unboundedPreceding, -1)
    edge = placed.where(F.col("__bucket") == F.col("__end")).withColumn(
        "__left", F.col("__rest") - F.col("__before") - F.coalesce(F.sum(size_col).over(before), F.lit(0)))
    edge = edge.withColumn("taken", size_col * passes + F.greatest(
        F.lit(0), F.least(size_col, F.col("__left"))))
    return inner.select(*own, F.col("taken").cast("long")).unionByName(
        edge.select(*own, F.col("taken").cast("long")))
