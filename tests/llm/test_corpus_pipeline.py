"""The corpus pipeline: stages one by one, and the whole run."""
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from contactlane.llm import queries
from test_ngram_join import brute
from test_pii import base_spans

SF = "/root/testdata/sf0.01"


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_stage_keeps_clean_documents(spark):
    kept = P.drop_low_quality(spark, docs(spark), SF)
    assert kept.columns == docs(spark).columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in ids for i in good) / len(good) > 0.95 and sum(i in ids for i in bad) / len(bad) < 0.1


def test_one_of_each_class_stays(spark):
    rows = docs(spark).orderBy("doc_id").collect()
    want = {rows[c]["doc_id"] for _, c in brute([r["text"] for r in rows], 5, 80, 100)}
    assert {r["doc_id"] for r in P.one_of_near_duplicates(spark, docs(spark), SF).collect()} == want


def test_pii_and_mixing_stages(spark):
    redacted = P.redact_pii(spark, docs(spark), SF)
    assert redacted.columns == docs(spark).columns
    for r in redacted.collect():
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    mixed = P.mix_sources(spark, docs(spark), SF)
    assert mixed.columns == docs(spark).columns
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3


def test_edge_rows_pass_every_stage(spark):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, "w " * 200_000, "en", "a", 1), (3, "x y z", "en", "b", 5),
            (None, "mail a@b.org now", "en", "b", 3), (5, "x y z", "en", "b", 5), (5, "x y z", "en", "b", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = df.selectExpr("*", "1 AS size", "'s' AS sources", "2 AS q_chars", "'t' AS taken", "3 AS set_key", "4 AS __row2")
    for name, stage in P.STAGES:
        out = stage(spark, clash, SF)
        assert name == "tokens" or out.columns == clash.columns, name
        assert out.count() <= 3 * len(rows)
        assert stage(spark, clash.limit(0), SF).count() == 0


def test_run(spark):
    rows = P.run(spark, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known = {r["doc_id"] for r in docs(spark).select("doc_id").collect()}
    assert rows and {r["doc_id"] for r in rows} <= known
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert not any(base_spans(library.decode(r["ids"])) for r in rows)


def test_quality_stage_without_usable_labels_keeps_all(spark, monkeypatch):
    few = docs(spark).limit(50).cache()
    none = spark.createDataFrame([], "doc_id long, label int")
    one = few.select("doc_id", F.lit(0).alias("label"))
    for labels in (none, one):
        monkeypatch.setattr(queries, "quality_labels", lambda s, d, labels=labels: labels)
        kept = P.drop_low_quality(spark, few, SF)
        assert kept.columns == few.columns and kept.count() == few.count()
