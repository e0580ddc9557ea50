"""Registered queries: each operator over its whole table, production parameters."""

from __future__ import annotations

import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, hard_negatives, lm, merkle, mixing, ngram_join, packing, pii, quality, \
    store, topk, url_filter, vectors

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(column: str, parts: int):
    """crc32 of an id's text modulo ``parts`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts


# The explicit URL rules (verdict, host, path).
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and its component by similarity."""
    return ngram_join.classes(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              n=4, num=85, den=100)


# The mix's weights, dealt to the sources in turn.
MIX_WEIGHTS = (5, 2, 1)


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    sizes = store.stored(table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = mixing.source_sizes(sizes)
    weights = [MIX_WEIGHTS[i % len(MIX_WEIGHTS)] for i in range(len(sources))]
    targets = mixing.share_targets([n for _, n in sources], weights)
    quotas = {s: math.floor(t + 0.5) for (s, _), t in zip(sources, targets)}
    taken = mixing.mix(sizes.withColumn("sources", F.array("source")), quotas)
    known = spark.createDataFrame([(s, n, t) for (s, n), t in zip(sources, targets)],
                                  "name string, source_size long, target double")
    return taken.join(known, taken["source"].eqNullSafe(known["name"])).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 near vectors of every 20th vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                       F.col("id") % 20 == 0, k=20)


@query
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and attention-model log probabilities of every document."""
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"),
                    crc_remainder("doc_id", 7) == 2, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every 50th vector."""
    rows = table(spark, sf_dir, "embeddings").where(vectors.usable(F.col("embedding")))
    return topk.top_k(rows.select("vec_id", topk.scaled(F.col("embedding")).alias("vec")),
                      F.col("vec_id") % 50 == 0, k=5)


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations in the chat format."""
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, explicit rule and verdict of every page."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge_urls(
        table(spark, sf_dir, "pages").select("page_id", "url"), labels, URL_RULES,
        min_support=0.001, min_confidence=0.5).select(
        "page_id", "host", "path", "rule", "verdict", "confidence", "matched")


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, spans = F.col("pii_base"), F.col("pii_spans")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS],
                        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
                        pii.spans_text(spans).alias("spans"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary,
                         keep_text=False)
    return bpe.decode(encoded, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


PREDICT_AT = 0.7


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label``: one label per id (the lower one, if they differ)."""
    return table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("label"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a quarter of the ids is held out."""
    stats = store.stored(quality.with_stats(
        table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False), "quality-stats")
    held_out = crc_remainder("doc_id", 4) == 2
    model = quality.fit(stats.where(~held_out).join(quality_labels(spark, sf_dir), "doc_id"))
    return stats.select("doc_id", held_out.alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0))


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    pieces = packing.sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               window=1024, end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector."""
    rows = table(spark, sf_dir, "embeddings").where(vectors.usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        rows.select("vec_id", label.alias("label"), topk.scaled(F.col("embedding")).alias("vec")),
        F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check of every document; half of them are held
    against a text without its line ends."""
    docs = table(spark, sf_dir, "documents")

    def digest(text):
        return merkle.digest_of([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    now = F.when(crc_remainder("doc_id", 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(
        F.col("text"))
    proofs = merkle.manifest(docs, digest(F.col("text")), digest(now), tree="source", key="doc_id")
    return proofs.select("doc_id", "leaf", "subroot", "root",
                         F.sha2(merkle.siblings_text(F.col("proof")), 256).alias("proof_sha256"),
                         "folded_root", "verified")
