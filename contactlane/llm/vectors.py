"""Shared preparation of vector tables for the two search operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

MAX_PIVOTS = 1024


def usable(vec: Column) -> Column:
    """Neither NULL nor holding a NULL, NaN or infinite component."""
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) != F.lit(float("inf"))))


def matrix(column: pa.Array) -> list[np.ndarray]:
    """Rows of a list column as arrays (views of one buffer)."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum([0] + [len(x) if x.is_valid else 0 for x in column])
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def pick_pivots(vectors: DataFrame, vec: str, count: int, seed: int = 0) -> dict[int, np.ndarray]:
    """At most ``count`` (and ``MAX_PIVOTS``) vectors in seeded hash order, as
    one matrix for each length of vector."""
    rows = vectors.select(vec).distinct().orderBy(F.xxhash64(F.lit(seed), vec), vec).limit(
        min(count, MAX_PIVOTS)).collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r[0]), []).append(r[0])
    return {d: np.array(own, dtype=float).reshape(len(own), d) for d, own in by_dim.items()}


def with_pivot(vectors: DataFrame, vec: str, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``dim`` and ``pivot``: the pivot with the smallest distance (-1 where
    no pivot has the vector's length)."""
    names = [c for c in vectors.columns if c not in ("dim", "pivot")]
    schema = vectors.select(*names).schema.add("dim", "integer").add("pivot", "integer")
    half_norm = {d: (p * p).sum(axis=1) / 2 for d, p in pivots.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(vec))
            dims = np.array([len(r) for r in rows], dtype=np.int32)
            nearest = np.full(len(rows), -1, dtype=np.int32)
            for d in np.unique(dims):
                if int(d) in pivots:
                    at = np.flatnonzero(dims == d)
                    own = np.array([rows[i] for i in at], dtype=float).reshape(len(at), d)
                    nearest[at] = np.argmax(own @ pivots[int(d)].T - half_norm[int(d)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(dims), pa.array(nearest)], names=schema.names)

    store.ship(vectors.sparkSession)
    return vectors.select(*names).mapInArrow(run, schema)
