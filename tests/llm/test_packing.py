"""Sequences against the tokenizers library, plain best fit and their rules."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contactlane.llm import bpe, packing
from contactlane.llm.queries import REGISTRY

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def plain_best_fit(lengths, window):
    rooms, packed = [], []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [r for r in rooms if r >= lengths[item]]
        if fit:
            rooms.remove(min(fit))
            packed.append(min(fit) - lengths[item])
        else:
            packed.append(window - lengths[item])
        rooms.append(packed[-1])
    return sorted(r for r in rooms)


@pytest.mark.parametrize("window", [8, 10, 64, 1024])
def test_best_fit_equals_plain_search(window):
    rnd = random.Random(window)
    for _ in range(40):
        lengths = [rnd.randint(1, window) for _ in range(rnd.randint(0, 200))]
        packed = packing.best_fit(lengths, window)
        assert sorted(i for p in packed for i in p) == list(range(len(lengths)))
        assert sorted(window - sum(lengths[i] for i in p) for p in packed) == plain_best_fit(lengths, window)


@pytest.mark.parametrize("window,slack", [(8, 0), (16, 2), (1024, 8), (1000, 0)])
def test_no_window_is_padded_by_more_than_the_slack(window, slack):
    rnd = random.Random(slack + window)
    for kind in range(30):
        # every third time one size only, that no window holds twice
        lengths = ([window * 3 // 5] * 40 if kind % 3 == 0
                   else [rnd.randint(1, window) for _ in range(rnd.randint(0, 60))])
        starts = [rnd.randint(0, 5) * window for _ in lengths]
        windows = packing.pack_tails(lengths, starts, window, slack)
        got = defaultdict(list)
        for pieces in windows:
            fill = sum(n for _, _, n in pieces)
            assert 0 < fill <= window and (window - fill <= slack or fill & (fill - 1) == 0)
            for item, start, n in pieces:
                got[item].append((start, n))
        for i, n in enumerate(lengths):
            at = starts[i]
            for start, own in sorted(got[i]):
                assert start == at and own > 0
                at += own
            assert at == starts[i] + n


def check(rows, texts, library, window, slack):
    """rows of the operator against texts: key -> list of texts with that key."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window and (window - at <= slack or at & (at - 1) == 0)
    assert set(by_doc) == set(texts)
    for name, own in by_doc.items():
        wanted = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts[name]]
        if len(wanted) > 1:
            assert sum(r["length"] for r in own) == sum(map(len, wanted))
            continue
        ids = np.array(wanted[0], dtype="<u4")
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_query_covers_every_token_once(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = REGISTRY["op11_packing"](spark, SF).collect()
    check(rows, {r["doc_id"]: [r["text"]] for r in docs}, library, 1024, 8)


def test_edge_rows(spark, library):
    texts = [None, "", " ", "x", "word " * 5000, "<|endoftext|>a", "naïve 漢字 \U0001F600 ", "a\n\n \t b"]
    rows = [(i, t, "c", 1.0) for i, t in enumerate(texts)]
    rows += [(100, "same text here " * 20, "c", 1.0)] * 50 + [(None, "no id", "c", 2.0)] * 2 + [(200, "equal", "c", 1.0)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, length double").repartition(3)
    got = packing.sequences(df, PATH, window=64, slack=2)
    assert got.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    want = defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(t)
    check(got.withColumn("ids_crc32", F.crc32("ids")).collect(), want, library, 64, 2)
    assert packing.sequences(df.limit(0), PATH).count() == 0


def test_small_batches_and_other_vocabularies(spark, library, monkeypatch):
    # a file whose ids don't follow the ranks is encoded by the codec of operator 9
    own = bpe.codec(PATH)
    for text in ("plain words 123", "naïve 漢字\u0085 \x1c x", "a<|endoftext|>b"):
        assert packing.encoder(PATH)(text).tolist() == own.encode(text)
    df = spark.createDataFrame([(i, f"text number {i} " * (i % 40)) for i in range(300)], "doc_id long, text string")
    few = packing.sequences(df.coalesce(1), PATH, window=128, slack=0, batch_tokens=1500).withColumn("ids_crc32", F.crc32("ids"))
    check(few.collect(), {i: [f"text number {i} " * (i % 40)] for i in range(300)}, library, 128, 0)
