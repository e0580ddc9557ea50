"""URL filters: explicit host/path rules, and rules mined from labels.

Spark FP-growth mines frequent combinations of URL tokens together with a
"bad" label; combinations whose confidence and support reach the stated
minimum become block rules. Support has an absolute floor too: a rule needs
``LEAST_ROWS`` labelled rows that it fits, and the lower end of the Wilson
interval of its confidence must lie above the share of bad rows among all, so
that a host seen once or twice is not learned by heart. Rules are matched by an inverted index: each rule
is posted under its rarest token, a URL looks up its own tokens, and the
candidate rules found are checked for full containment. DataFrame functions
and Spark ML only.

Defined results: a NULL URL, or one without ``://``, has an empty host and
path, no tokens, fits no rule and is allowed; an empty label table, or one of
fewer than ``LEAST_ROWS`` usable rows, mines no rules; an empty page table gives
no rows; repeated rows and repeated URLs each keep their own result row; other
columns of the input are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"
# Labelled rows that a mined rule has to fit at least, and the normal quantile of
# the lower end of its confidence.
LEAST_ROWS = 20
CONFIDENCE_Z = 1.645


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(c, UPPER, LOWER)


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path`` (and ``__query``, what follows a ``?``)."""
    at = F.instr(F.col(url), "://")
    out = df.withColumn("__rest", F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url)))
                        .otherwise(""))
    out = out.withColumn("__raw", F.regexp_extract("__rest", "^[^/?#]*", 0))
    out = out.withColumn("__tail", F.substring(F.col("__rest"), F.length("__raw") + 1, F.length("__rest")))
    return out.withColumns({
        "host": lower_ascii(F.col("__raw")),
        "path": F.regexp_extract("__tail", "^[^?#]*", 0),
        "__query": F.regexp_extract("__tail", r"^[^?#]*\?([^#]*)", 1),
    }).drop("__rest", "__raw", "__tail")


def explicit_rule(host: Column, path: Column,
                  rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule ``(verdict, host, path)`` that
    fits: same host or a subdomain, path starting with the rule's."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def url_tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct tokens of a URL: host labels and the host itself, words of the
    path (not plain numbers), keys of the query."""
    def named(prefix: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: (w != "") & ~w.rlike("^[0-9]+$")),
                           lambda w: F.concat(F.lit(prefix), w))

    hosts = F.concat(F.split(host, r"[.-]"), F.array(host))
    keys = F.transform(F.split(query, "&"), lambda kv: F.substring_index(kv, "=", 1))
    return F.array_distinct(F.concat(named("h:", hosts), named("p:", F.split(lower_ascii(path), "[/._-]")),
                                     named("q:", keys)))


def lowest_confidence(confidence: Column, rows: Column) -> Column:
    """Lower end of the Wilson interval of a share seen in ``rows`` rows."""
    z2 = CONFIDENCE_Z ** 2
    spread = F.sqrt(confidence * (1 - confidence) / rows + z2 / (4 * rows * rows))
    return (confidence + z2 / (2 * rows) - CONFIDENCE_Z * spread) / (1 + z2 / rows)


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float,
               tokens: str = "tokens", bad: str = "bad", least_rows: int = 1,
               above_base: bool = False) -> DataFrame:
    """Block rules ``antecedent, confidence, support, key`` from labelled token
    sets (``bad`` boolean).

    ``support`` is the share of labelled rows holding the whole combination and
    the label; ``least_rows`` of them have to hold the combination. With
    ``above_base`` the lower end of the confidence has to lie above the share of
    bad rows. A combination is dropped when a part of it is a rule already.
    ``key`` is the rule's rarest token, its place in the inverted index.
    """
    spark = labelled.sparkSession
    items = labelled.where(F.col(bad).isNotNull()).select(F.array_distinct(F.when(
        F.col(bad), F.array_append(tokens, F.lit(BAD))).otherwise(F.col(tokens))).alias("items"))
    n, n_bad = items.agg(F.count(F.lit(1)), F.count_if(F.array_contains("items", BAD))).first()
    if n < least_rows:
        return spark.createDataFrame([], "rule long, antecedent array<string>, confidence double, "
                                         "support double, key string")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                     numPartitions=max(8, spark.sparkContext.defaultParallelism)).fit(items)
    fits = F.round(F.col("support") * n / F.col("confidence"))  # rows that hold the combination
    rules = model.associationRules.where(
        (F.size("consequent") == 1) & (F.col("consequent")[0] == BAD)).where(
        (fits >= least_rows) & (lowest_confidence(F.col("confidence"), fits) > (n_bad / n if above_base else -1.0))
    ).select(
        F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    single = model.freqItemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), F.col("freq"))
    parts = rules.withColumn("token", F.explode("antecedent")).join(single, "token")
    keyed = parts.groupBy("antecedent", "confidence", "support").agg(
        F.min(F.struct("freq", "token"))["token"].alias("key"))
    keyed = keyed.withColumn("rule", F.xxhash64(F.array_join("antecedent", "\n")))
    longer = keyed.select(F.col("rule").alias("long_rule"), F.col("antecedent").alias("long"),
                          F.explode("antecedent").alias("key"))
    covered = longer.join(keyed.select("key", "rule", "antecedent"), "key").where(
        (F.col("rule") != F.col("long_rule"))
        & (F.size(F.array_except("antecedent", "long")) == 0)).select(
        F.col("long_rule").alias("rule")).distinct()
    return keyed.join(covered, "rule", "left_anti").select(
        "rule", "antecedent", "confidence", "support", "key")


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url",
                tokens: str = "tokens") -> DataFrame:
    """``url, confidence, matched``: URLs (distinct, with their tokens) that hold
    all tokens of some rule, with the best confidence and the number of rules."""
    posted = urls.select(url, tokens, F.explode(tokens).alias("key"))
    found = posted.join(rules.select("rule", "antecedent", "confidence", "key"), "key").where(
        F.size(F.array_except("antecedent", tokens)) == 0)
    return found.groupBy(url).agg(F.max("confidence").alias("confidence"),
                                  F.count(F.lit(1)).alias("matched"))


def judge_urls(pages: DataFrame, labels: DataFrame, explicit: Sequence[tuple[str, str, str]],
               min_support: float, min_confidence: float, url: str = "url",
               label_key: str = "doc_id", least_rows: int = LEAST_ROWS) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, confidence, matched``.

    ``labels`` has ``label_key`` and a boolean ``bad`` for the document that a
    URL serves; a URL names its document by the first all-digit path segment.
    The explicit rule decides where one fits; else the mined rules do. Columns of
    ``pages`` with the names of the added ones are replaced.
    """
    added = ("host", "path", "rule", "verdict", "confidence", "matched")
    own = [c for c in pages.columns if c not in added]
    rows = pages.select(F.struct(*own).alias("__row"), F.col(url).alias("url"))
    parsed = with_host_path(rows)
    parsed = parsed.withColumn("tokens", url_tokens(F.col("host"), F.col("path"), F.col("__query")))
    served = parsed.select("tokens", F.regexp_extract("path", r"/([0-9]{1,18})(?:[/.]|$)", 1).alias("n"))
    served = served.where("n <> ''").select("tokens", F.col("n").cast("long").alias("label_id"))
    known = labels.groupBy(F.col(label_key).alias("label_id")).agg(F.max("bad").alias("bad"))
    rules = mine_rules(served.join(known, "label_id"), min_support, min_confidence, least_rows=least_rows,
                       above_base=True)
    distinct = parsed.select("url", "tokens").where(F.col("url").isNotNull()).dropDuplicates(["url"])
    hits = match_rules(distinct, rules)
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), explicit)
    # joined on another form of the key than hits were counted by, so that Spark can
    # split a repeated URL; rows without a URL spread by their own columns
    spread = F.when(F.col("url").isNull(), F.xxhash64("__row")).otherwise(F.xxhash64("url"))
    judged = parsed.drop("__query", "tokens").withColumn("__spread", spread).join(
        hits.withColumn("__spread", F.xxhash64("url")), ["__spread", "url"], "left")
    return judged.select(
        "__row.*", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("matched") > 0, "block").otherwise("allow")).alias("verdict"),
        "confidence", F.coalesce("matched", F.lit(0).cast("long")).alias("matched"))
