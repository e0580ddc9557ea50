"""Connected components of an edge table by alternating star operations.

First every task joins what its own edges connect: each node of its edges then
has one edge, to the smallest node that they reach. Large-star links every larger
neighbour of a vertex to its smallest neighbour, small-star does so with the
smaller ones; both only aggregate minima (map-side first) and join them back, so a
vertex with very many neighbours is no bottleneck. Each round is written to the
shared folder; the rounds end when each node has one edge, to a node without one.
Self loops, repeated edges and edges in both directions are allowed; an empty
table has no vertices.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

# Nodes that one task joins at once (some 200 bytes each); then it begins anew.
LOCAL_NODES = 500_000


def local_stars(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect the same nodes: within each task, and for every
    ``LOCAL_NODES`` nodes there, from each node to the smallest one it reaches."""
    limit = LOCAL_NODES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(node: int) -> int:
            while (up := above.setdefault(node, node)) != node:
                above[node] = node = above.setdefault(up, up)
            return node

        def stars() -> pa.RecordBatch:
            found = [(node, end) for node in list(above) if (end := top(node)) != node]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                               pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = top(a), top(b)
                above[max(a, b)] = min(a, b)
            if len(above) >= limit:
                yield stars()
                above.clear()
        yield stars()

    store.ship(edges.sparkSession)
    return edges.mapInArrow(run, "a long, b long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation; an edge gives one edge at most, repeated ones stay."""
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = near.join(least, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
    return out.where(F.col("a") != F.col("b"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct edges has one edge, to a node without one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return seen.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each node of ``edges`` (``a, b``,
    integers) is connected with, itself included."""
    spark = edges.sparkSession
    plain = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    now, path = store.stored_at(local_stars(plain).distinct(), "edges")
    while not _are_stars(now):
        nxt, new_path = store.stored_at(_star(_star(now, True), False).distinct(), "edges")
        store.remove(spark, path)
        now, path = nxt, new_path
    # every edge now leads from a node to its component's smallest node
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select("b", "b").distinct())
