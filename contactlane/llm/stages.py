"""The stages of the corpus pipeline: operators applied to whole documents tables.

Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``docs``, each row passing as one struct, so that extra
columns of any name come through.
"""

from __future__ import annotations

import math

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, mixing, ngram_join, pii, quality, queries, store


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the quality classifier rejects go. It is
    fitted on labelled documents that aren't held out -- all, or a hash sample of
    about ``quality.FIT_ROWS`` labels, so that the sample, not the texts, is sent
    around; where that gives no rules (no usable labels, labels of one value,
    few rows), all documents stay."""
    labels = queries.quality_labels(spark, sf_dir).where(
        (queries.crc_remainder("doc_id", 4) != 2) & F.col("label").isin(0, 1))
    parts, n = 1 << 20, labels.count()
    sample = labels
    if n > quality.FIT_ROWS:
        sample = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < int(parts * quality.FIT_ROWS / n))
    # at most FIT_ROWS ids and labels, but for chance: under a megabyte
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    with store.scope(spark):
        model = quality.fit(store.stored(quality.with_stats(known, keep_text=False), "quality-stats"))
    if not model.rules:
        return docs
    rows = quality.with_stats(docs.select(F.struct(*docs.columns).alias("__row"), F.col("text")), keep_text=False)
    return rows.where(model.score() >= queries.PREDICT_AT).select("__row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each class stays (five-word shingles,
    Jaccard similarity of 0.8 or more)."""
    return ngram_join.representatives(docs, n=5, num=80, den=100)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: personal data is replaced by tags; ``n_chars`` follows."""
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col("text").alias("__new"))
    changed = pii.redact(rows, text="__new").select("__row.*", "__new")
    return changed.withColumns({"text": F.col("__new"), "n_chars": F.length("__new").cast("long")}).select(
        *docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents taken (whole, up to three times) so that the sources
    come near their target weights."""
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", F.col("source").alias("source"),
                       F.array("source").alias("sources"), mixing.word_count(F.col("text")).alias("size"))
    sizes = store.stored(rows.select("doc_id", "source", "sources", "size"), "mix-sizes")
    sources = mixing.source_sizes(sizes)
    weights = [queries.MIX_WEIGHTS[i % len(queries.MIX_WEIGHTS)] for i in range(len(sources))]
    targets = mixing.share_targets([n for _, n in sources], weights)
    quotas = {s: math.floor(t + 0.5) for (s, _), t in zip(sources, targets)}
    return mixing.repeated(mixing.mix(rows, quotas, slim=sizes)).select("__row.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: token ids of every text."""
    slim = docs.select("doc_id", "lang", "source", "text")
    return bpe.encode(slim, public_tokenizers.path("byte_bpe_50k.json"), keep_text=False).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")
