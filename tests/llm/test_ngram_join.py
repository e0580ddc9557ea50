"""Similarity classes against all-pairs brute force."""
import gc
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contactlane.llm import bpe
from contactlane.llm import ngram_join as J
from contactlane.llm.components import components
from contactlane.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def gram_set(text, n):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(texts, n, num, den):
    """``[(set size, class number)]`` by position."""
    sets = [gram_set(t, n) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, own in enumerate(sets):
        for j, both in Counter(j for g in own for j in index[g]).items():
            if den * both >= num * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for g in own:
            index[g].append(i)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def edited(rnd, words, share):
    out = list(words)
    for i in range(len(out)):
        if rnd.random() < share:
            out[i] = f"e{rnd.randint(0, 10 ** 6)}"
    return out


def corpus(seed, families=12, most=30):
    """Families of texts at all distances, passages that many texts share."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for f in range(families):
        words = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(1, 160))]
        for _ in range(rnd.randint(1, most)):
            own = edited(rnd, words, rnd.choice([0, 0.005, 0.01, 0.02, 0.03]))
            if rnd.random() < 0.3:
                own = own[: rnd.randint(0, len(own))] + passage
            texts.append(" ".join(own) if rnd.random() < 0.8 else "\t".join(own).upper() + "\n")
    return texts + ["", None, " \n", "one", "One", "one two", "É é", "é É", " ".join(passage)] * 2


def compared(spark, texts, n, num, den):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.classes(df, n=n, num=num, den=den).collect()}
    want = brute(texts, n, num, den)
    assert got == dict(enumerate(want))
    return want


@pytest.mark.parametrize("seed,n,num", [(1, 4, 85), (2, 5, 80)])
def test_classes_equal_brute_force(spark, seed, n, num):
    want = compared(spark, corpus(seed), n, num, 100)
    assert 5 < len(set(c for _, c in want)) < len(want)


def test_large_shards_are_searched_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(J, "CHUNK_SETS", 6)
    compared(spark, corpus(3, families=4, most=40), 4, 85, 100)


def test_divide_skip_finds_what_intersection_finds():
    rng = np.random.default_rng(4)
    for _ in range(60):
        base = rng.integers(0, 1 << 62, size=rng.integers(3, 90)).astype(np.uint64)
        sets = []
        for _ in range(rng.integers(2, 30)):
            own = base.copy()
            cut = rng.integers(0, len(own) // 4 + 1)
            own[rng.choice(len(own), cut, replace=False)] = rng.integers(0, 1 << 62, size=cut).astype(np.uint64)
            sets.append(np.unique(own))
        index = J.Shard(sets)
        for q in sets:
            got = sorted(index.search(q, np.ones(len(sets), bool), 85, 100))
            assert got == [i for i, s in enumerate(sets) if 100 * (o := len(np.intersect1d(q, s)))
                           >= 85 * (len(q) + len(s) - o)]


def test_merge_skip_counts():
    rnd = random.Random(8)
    for _ in range(200):
        lists = [sorted(rnd.sample(range(40), rnd.randint(0, 20))) for _ in range(rnd.randint(1, 9))]
        least = rnd.randint(1, 5)
        count = Counter(x for own in lists for x in own)
        assert J.merge_skip(lists, least) == {x: c for x, c in count.items() if c >= least}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 100), (300, 300), (7, 90), (100, 150)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 0, 100: 100, 150: 100, 200: 100}
    assert components(df.limit(0)).count() == 0


def test_components_take_few_rounds(spark, monkeypatch):
    from contactlane.llm import components as module, store
    written, real = [], store.stored_at
    monkeypatch.setattr(store, "stored_at", lambda df, name: written.append(name) or real(df, name))
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r["node"]: r["label"] for r in components(chain.coalesce(1)).collect()}
    assert got == {i: 0 for i in range(301)} and len(written) == 1
    # the same over many tasks, each beginning anew after a few nodes
    monkeypatch.setattr(module, "LOCAL_NODES", 8)
    mixed = chain.where("a % 50 <> 7").withColumn("z", F.rand(3)).repartition(5).orderBy("z").select("a", "b")
    mixed = mixed.union(mixed.select("b", "a")).union(spark.createDataFrame([(3, 3), (-4, 299)], "a long, b long"))
    want = {}
    for i in range(301):
        want[i] = i if i % 50 == 8 or not i else want[i - 1]
    last = want[299]
    want = {i: -4 if x == last else x for i, x in want.items()} | {-4: -4}
    assert {r["node"]: r["label"] for r in components(mixed).collect()} == want


def test_null_and_repeated_ids(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "only null"), (None, "only null"),
            (9, None), (8, "A B C D E F"), (8, "other words entirely here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in J.classes(df).collect())))
    assert got == sorted(map(str, [(5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 1, None), (None, 1, None), (9, 0, 9),
                                   (8, 2, 5), (8, 1, 8)]))
    assert J.classes(df.limit(0)).count() == 0


def test_one_row_of_each_class_stays(spark):
    rows = [(5, "a b c d e f", 1), (5, "a b c d e f", 2), (None, "a b c d e f", 3), (None, "only null", 4),
            (9, None, 5), (9, "", 5), (8, "A B C D E F", 6), (7, "unique", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, set_key int")
    out = sorted(r["set_key"] for r in J.representatives(df).collect())
    assert out == [1, 4, 5, 5, 7]
    assert J.representatives(df).columns == df.columns


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    want = brute([d["text"] for d in docs], 4, 85, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in REGISTRY["op1_ngram_join"](spark, SF).collect()}
    assert got == {d["doc_id"]: (n, docs[c]["doc_id"]) for d, (n, c) in zip(docs, want)}


def test_long_text(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, long), (2, long + " end"), (3, "w1 w2 w3 w4")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in J.classes(df, n=4, num=85).select("*", F.lit(1)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_workers_let_go_of_the_tokenizer(spark):
    rows = [(i, f"some text of words {i % 40} that has {i % 7} copies") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8).cache()
    bpe.encode(df, public_tokenizers.path("byte_bpe_50k.json")).count()

    def codecs(batches):
        for batch in batches:
            n = sum(type(x).__name__ == "Codec" for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(batch))], names=["n"])

    assert J.representatives(df).count() == len({text for _, text in rows})
    assert {r["n"] for r in df.select("doc_id").mapInArrow(codecs, "n long").collect()} == {0}


def test_store_keeps_one_thing_at_a_time():
    made = []
    for name in ("a", "a", "b", "a"):
        assert J.store.kept(name, lambda name=name: made.append(name) or name) == name
    assert made == ["a", "b", "a"]
    J.store.keep_nothing()
    assert not J.store._KEPT
