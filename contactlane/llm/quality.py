"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics are counted per text; a small random forest is grown on labelled
rows, every path from a root becomes a conjunctive rule ("share of upper case
> 0.4 and mean word length <= 5"), an L1-penalised logistic regression weighs
the rules, and the rules that keep a weight are compiled into one Spark column
expression over the statistics.

The fit uses at most about ``FIT_ROWS`` labelled rows, chosen by a hash of the
id (all of them, when there are fewer); everything else covers all rows.

Defined results: NULL text counts as empty, whose statistics are all 0; with no
labelled row, or labels of one value only, the score is the smoothed share of
label 1; rows with NULL labels don't take part; repeated rows get equal scores;
columns of the input named like a statistic are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store

# Bound of the labelled rows that the classifier is fitted on.
FIT_ROWS = 40_000
TREES, DEPTH, LEAST_ROWS = 12, 4, 20
LASSO = 0.0008
SEED = 17

STATS = ("q_chars", "q_words", "q_word_len", "q_long_word", "q_upper", "q_digit", "q_other_ascii",
         "q_bang", "q_bar", "q_symbol", "q_space", "q_newline", "q_wide", "q_distinct", "q_top_word",
         "q_top_pair", "q_line_len", "q_line_repeat", "q_capital", "q_word_mark", "q_stop")

_UPPER = np.arange(ord("A"), ord("Z") + 1)
_DIGIT = np.arange(ord("0"), ord("9") + 1)
_SYMBOL = np.frombuffer(b"#$%&*<>{}[]\\^_`~=@", dtype=np.uint8)
_MARK = np.frombuffer(b".,;:?'\"()-/+", dtype=np.uint8)


def text_stats(text: bytes) -> tuple[float, ...]:
    """The statistics of one text (UTF-8), in the order of ``STATS``."""
    n = len(text)
    if not n:
        return (0.0,) * len(STATS)
    hist = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = text.split(b"\n")
    pairs = Counter(zip(words[::2], words[1::2]))
    marked = sum(c for w, c in counts.items() if not w[-1:].isalnum() and w[-1] < 128)
    capital = sum(c for w, c in counts.items() if w[:1].isupper())
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    return (
        float(np.log1p(n)), float(np.log1p(len(words))), sum(map(len, words)) / m,
        float(max(map(len, counts), default=0)), hist[_UPPER].sum() / n, hist[_DIGIT].sum() / n,
        hist[_MARK].sum() / n, hist[ord("!")] / n, hist[ord("|")] / n, hist[_SYMBOL].sum() / n,
        hist[ord(" ")] / n, hist[ord("\n")] / n, hist[128:].sum() / n, len(counts) / m,
        max(counts.values(), default=0) / m, 2 * max(pairs.values(), default=0) / m,
        float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines), capital / m, marked / m,
        short / m)


def with_stats(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with the statistics of ``text`` (doubles). Only the text goes to
    the Python workers; other columns stay where they are."""
    struct = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])

    @F.arrow_udf(struct)
    def counted(texts: pa.Array) -> pa.Array:
        rows = np.array([text_stats((t.as_py() or "").encode()) for t in texts], dtype=float)
        rows = rows.reshape(len(texts), len(STATS))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(STATS))], names=list(STATS))

    store.ship(df.sparkSession)
    keep = [c for c in df.columns if c not in STATS and (keep_text or c != text)]
    return df.select(*keep, counted(F.col(text)).alias("__stats")).select(*keep, "__stats.*")


# A rule: conditions (statistic, True for "<=" or False for ">", threshold).
Rule = tuple[tuple[str, bool, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``score()`` is the probability of label 1 as a column."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{weight:+.3f}  " + " and ".join(f"{s} {'<=' if low else '>'} {t:.4g}"
                                                  for s, low, t in rule)
                for rule, weight in sorted(self.rules, key=lambda r: -abs(r[1]))]


def rule_column(rule: Rule) -> Column:
    out = F.lit(True)
    for stat, low, threshold in rule:
        out = out & ((F.col(stat) <= threshold) if low else (F.col(stat) > threshold))
    return out


def tree_rules(node, path: Rule = ()) -> Iterator[Rule]:
    """Every non-empty root path of a fitted Spark tree (inner nodes too)."""
    if path:
        yield path
    if node.subtreeDepth():
        split = node.split()
        stat, threshold = STATS[split.featureIndex()], split.threshold()
        yield from tree_rules(node.leftChild(), simplified(path + ((stat, True, threshold),)))
        yield from tree_rules(node.rightChild(), simplified(path + ((stat, False, threshold),)))


def simplified(rule: Rule) -> Rule:
    """One bound per statistic and direction, in a fixed order."""
    best: dict[tuple[str, bool], float] = {}
    for stat, low, t in rule:
        key = (stat, low)
        best[key] = t if key not in best else (min if low else max)(best[key], t)
    return tuple(sorted((s, low, t) for (s, low), t in best.items()))


def fit(labelled: DataFrame, label: str = "label", key: str = "doc_id", rows: int = FIT_ROWS) -> RuleModel:
    """Fit on a table with the statistics, a 0/1 ``label`` and an id."""
    # Spark ML is for the driver alone; workers that count statistics don't load it.
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = labelled.where(F.col(label).isin(0, 1))
    seen = {r[0]: r[1] for r in known.groupBy(F.col(label).cast("int")).count().collect()}
    n, ones = sum(seen.values()), seen.get(1, 0)
    if not 0 < ones < n:
        return RuleModel((), float(np.log((ones + 1) / (n - ones + 1))))
    parts = 1 << 20
    if n > rows:
        known = known.where(F.pmod(F.xxhash64(key), F.lit(parts)) < int(parts * rows / n))
    data = VectorAssembler(inputCols=list(STATS), outputCol="features").transform(
        known.select(F.col(label).cast("double").alias("label"), *STATS)).select("label", "features", *STATS)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAST_ROWS,
                                    seed=SEED, featureSubsetStrategy="onethird").fit(data)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree._java_obj.rootNode())})
    if not rules:
        return RuleModel((), float(np.log((ones + 1) / (n - ones + 1))))
    names = [f"r{i}" for i in range(len(rules))]
    matrix = VectorAssembler(inputCols=names, outputCol="features").transform(
        data.select("label", *[rule_column(r).cast("double").alias(c) for c, r in zip(names, rules)]))
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=60,
                               standardization=False).fit(matrix.select("label", "features"))
    weights = lasso.coefficients.toArray()
    return RuleModel(tuple((r, float(w)) for r, w in zip(rules, weights) if w), float(lasso.intercept))
