"""Held-out accuracy and edge cases of the rule ensemble."""
import math

import pytest
from pyspark.sql import functions as F

from contactlane.llm import quality
from contactlane.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = REGISTRY["op10_quality"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == docs and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50
    assert sum(a == b for a, b in held) / len(held) > 0.93


def test_edge_texts_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (3, " \n "), (4, "word " * 300_000), (None, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("q_chars", F.lit("clash"))
    out = quality.with_stats(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i][s] == 0.0 for i in (1, 2) for s in quality.STATS)
    assert by[3]["q_words"] == 0.0 and by[4]["q_distinct"] < 0.001
    assert quality.with_stats(df.limit(0)).count() == 0


def stats_frame(spark, rows):
    return quality.with_stats(spark.createDataFrame(rows, "doc_id long, text string, label int"))


def test_no_labels_or_one_value(spark):
    none = quality.fit(stats_frame(spark, []))
    ones = quality.fit(stats_frame(spark, [(1, "a", 1), (2, "b", 1), (3, "c", None)]))
    one = stats_frame(spark, [(9, None, None)])
    assert one.select(none.score().alias("s")).first()["s"] == 0.5
    assert one.select(ones.score().alias("s")).first()["s"] == 0.75


def test_rules_are_compiled_into_columns(spark):
    rows = [(i, ("LOUD!! " if i % 3 == 0 else "calm words here. ") * (5 + i % 7), int(i % 3 != 0)) for i in range(300)]
    df = stats_frame(spark, rows)
    model = quality.fit(df)
    assert model.rules and model.describe()
    out = df.select("label", model.score().alias("s")).collect()
    assert all((r["s"] >= 0.7) == (r["label"] == 1) for r in out)
    assert quality.simplified((("a", True, 3.0), ("a", True, 2.0), ("b", False, 1.0))) == (
        ("a", True, 2.0), ("b", False, 1.0))


def most(items):
    seen = {}
    for x in items:
        seen[x] = seen.get(x, 0) + 1
    return max(seen.values(), default=0)


def plain_stats(text):
    """The statistics by their meaning, byte by byte and word by word."""
    b = (text or "").encode()
    if not b:
        return dict.fromkeys(quality.STATS, 0.0)
    words, lines = b.split(), b.split(b"\n")
    m = max(1, len(words))
    share = lambda test: sum(1 for c in b if test(c)) / len(b)
    words_that = lambda test: sum(1 for w in words if test(w)) / m
    return {
        "q_chars": math.log(1 + len(b)), "q_words": math.log(1 + len(words)), "q_word_len": sum(map(len, words)) / m,
        "q_long_word": max(map(len, words), default=0), "q_upper": share(lambda c: 65 <= c <= 90),
        "q_digit": share(lambda c: 48 <= c <= 57), "q_other_ascii": share(lambda c: c in b".,;:?'\"()-/+"),
        "q_bang": share(lambda c: c == 33), "q_bar": share(lambda c: c == 124),
        "q_symbol": share(lambda c: c in b"#$%&*<>{}[]\\^_`~=@"), "q_space": share(lambda c: c == 32),
        "q_newline": share(lambda c: c == 10), "q_wide": share(lambda c: c > 127), "q_distinct": len(set(words)) / m,
        "q_top_word": most(words) / m,
        "q_top_pair": 2 * most((words[i], words[i + 1]) for i in range(0, len(words) - 1, 2)) / m,
        "q_line_len": math.log(1 + len(b) / len(lines)), "q_line_repeat": 1 - len(set(lines)) / len(lines),
        "q_capital": words_that(lambda w: 65 <= w[0] <= 90),
        "q_word_mark": words_that(lambda w: w[-1] < 128 and not chr(w[-1]).isalnum()),
        "q_stop": words_that(lambda w: len(w) <= 3)}


def plain_score(model, stats):
    total = model.intercept
    for rule, weight in model.rules:
        if all((stats[s] <= t) if low else (stats[s] > t) for s, low, t in rule):
            total += weight
    return 1 / (1 + math.exp(-total))


def test_query_equals_plain_evaluation(spark, monkeypatch, tmp_path):
    """Every score of the registered query from statistics and rules in plain Python."""
    models, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: models.append(fit(*a, **k)) or models[-1])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = REGISTRY["op10_quality"](spark, SF).collect()
    assert len(rows) == len(texts) and models[0].rules
    for r in rows:
        assert r["score"] == pytest.approx(plain_score(models[0], plain_stats(texts[r["doc_id"]])), abs=1e-9)
    # NULL and repeated ids, clashing columns, an empty table
    clash = "doc_id long, text string, label string, score string, __stats string, q_bang string, quality int"
    odd = [(None, "a b", "x", "x", "x", "x", 0), (5, None, "x", "x", "x", "x", 0), (5, "b " * 9, "x", "x", "x", "x", 0),
           (5, "b " * 9, "x", "x", "x", "x", 0)]
    for name, own in (("odd", odd), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(own, clash).write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        got = REGISTRY["op10_quality"](spark, folder).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in own)
        assert all(0 <= r["score"] <= 1 for r in got)
