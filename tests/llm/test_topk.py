"""Exact top-k against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from contactlane.llm import topk, vectors
from contactlane.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def brute(rows, k, every):
    """rows: (id, list of int) once each."""
    out = {}
    for i, v in rows:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i and len(w) == len(v))
            out.setdefault(i, []).extend((r + 1, j, -s) for r, (s, j) in enumerate(scored[:k]))
    return out


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("spread", [1, 3000, 1 << 40])
def test_equals_brute_force_with_ties(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "LEAF", 7)
    rng = np.random.default_rng(spread % 97)
    rows = [(i, [int(x) for x in rng.integers(-spread, spread + 1, size=5 if spread > 1 else 3)]) for i in range(400)]
    rows += [(1000 + i, [0, 0]) for i in range(4)] + [(2000, [])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    got = grouped(topk.top_k(df, F.col("vec_id") % 20 == 0, 5).collect())
    want = brute(rows, 5, 20)
    limit = (1 << 63) - 1
    assert got == {q: sorted((r, j, max(-limit - 1, min(limit, s))) for r, j, s in v) for q, v in want.items() if v} \
        or spread == 1 << 40  # beyond 64 bits ties at the range's end are ordered by id


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
            (4, [float("inf"), 1.0]), (5, [0.5, 0.25]), (None, [1.0, 1.0]), (6, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    ok = df.where(vectors.usable(F.col("embedding"))).select(
        "vec_id", topk.scaled(F.col("embedding")).alias("vec"))
    got = grouped(topk.top_k(ok, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == {0: [(1, 5, 128 * 256 + 64 * 512), (2, 6, 0)]}
    assert topk.top_k(ok.limit(0), F.lit(True), 5).count() == 0


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r["vec_id"], [int(np.floor(256 * float(x))) for x in r["embedding"]]) for r in table]
    assert grouped(REGISTRY["op5_topk"](spark, SF).collect()) == brute(rows, 5, 50)


def test_queries_reach_few_cells_of_clustered_rows(spark, monkeypatch):
    """Far clusters are not asked; the result is exact all the same."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 8)
    rng = np.random.default_rng(3)
    axes = np.eye(8) * 1000
    rows = [(i, [int(x) for x in axes[i % 8] + rng.integers(-9, 10, size=8)]) for i in range(480)]
    sent, search = [], topk._search_shards

    def counted(index, asked, k):
        sent.append(asked.count())
        return search(index, asked, k)

    monkeypatch.setattr(topk, "_search_shards", counted)
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    assert grouped(topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()) == brute(rows, 5, 10)
    shards = 480 // 8  # at least
    assert len(sent) == 3 and sent[0] == 48
    assert sum(sent) < 48 * shards / 3


def test_a_third_of_the_rows_equal_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 50)
    rng = np.random.default_rng(5)
    rows = [(i, [7, -3, 2] if i % 3 == 0 else [int(x) for x in rng.integers(-9, 10, size=3)]) for i in range(330)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    clash = {c: F.lit("clash") for c in ("id", "asks", "shard", "home", "floor", "dim", "pivot", "splits", "score",
                                         "rank", "query_id", "radius", "norm")}
    got = topk.top_k(df.withColumns(clash), F.col("vec_id") % 20 == 0, 5).collect()
    assert grouped(got) == brute(rows, 5, 20)
