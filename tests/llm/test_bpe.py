"""Ids and round trips against the tokenizers library."""
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contactlane.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


TEXTS = [None, "", " ", "\n\n  \t", "Hello world's  best", "<|endoftext|>", "a<|endoftext|> b  <|endoftext|>",
         "naïve café 漢字 \U0001F600\u200b\u0085\x1c", "1234 ²½Ⅷ", "a" * 5000, "ab" * 3000 + " " * 3000, "x",
         "don't we'll I'd 'S", "the " * 20000]


def test_encode_and_decode(spark, library):
    rows = [(i, t, 1.5) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], 2.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids double")
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False) == (r["text"] or "")


def test_random_texts(library):
    rnd, own = random.Random(5), bpe.codec(PATH)
    letters = "aab be'sllTt 12  \n\té漢ñ\U0001F600\x1c\x85.,!'re²"
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_short_and_long_words_merge_alike():
    rnd, own = random.Random(6), bpe.codec(PATH)
    for _ in range(300):
        ids = [own.byte_ids[rnd.choice(b"theandoring ")] for _ in range(rnd.randint(1, 200))]
        assert own.merge_short(list(ids)) == own.merge_long(list(ids))


def test_decode_of_partial_bytes_and_unknown_ids(spark, library):
    ids = library.encode("漢", add_special_tokens=False).ids
    df = spark.createDataFrame([(1, ids[:1]), (2, None), (3, []), (4, [999999])], "k long, ids array<int>")
    out = {r["k"]: r["decoded"] for r in bpe.decode(df, PATH).collect()}
    assert out[1] == library.decode(ids[:1], skip_special_tokens=False) and out[2] == out[3] == out[4] == ""
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, PATH).select(F.size("ids")).count() == 0
