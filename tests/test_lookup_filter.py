"""The filtered lookup gives the plain lookup's rows and shuffles possible hits only."""
import pytest
from pyspark.sql import functions as F

from contactlane.plans import joins

N = 20000


def shuffled_rows(df):
    """Records written by each exchange of a frame that has run."""
    def walk(node):
        name = node.nodeName()
        if "QueryStage" in name:
            yield from walk(node.plan())
        elif name == "AdaptiveSparkPlan":
            yield from walk(node.executedPlan())
        else:
            if name == "Exchange":
                yield node.metrics().get("shuffleRecordsWritten").get().value()
            children = node.children()
            for i in range(children.size()):
                yield from walk(children.apply(i))
    return list(walk(df._jdf.queryExecution().executedPlan()))


def frames(spark, tmpdir_path, hot=False):
    """Of the left rows a tenth has a known id, a tenth none at all."""
    k = F.when(F.col("id") % 10 == 0, F.concat(F.lit("K"), F.when(F.lit(hot), F.lit(0)).otherwise(F.col("id") % 1000))).when(
        F.col("id") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("U"), "id"))
    spark.range(N).select("id", k.cast("string").alias("k")).write.mode("overwrite").parquet(f"{tmpdir_path}/left")
    keys = spark.range(1000).select(F.concat(F.lit("K"), "id").alias("k")).union(spark.createDataFrame(
        [(None,), ("K1",)], "k string"))
    return spark.read.parquet(f"{tmpdir_path}/left"), keys


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def test_equal_rows_and_fewer_shuffled(spark, tmpdir_path, no_broadcast):
    left, keys = frames(spark, tmpdir_path)
    plain, filtered = joins.exists_flag(left, keys, "k", "k", "hit"), joins.exists_flag_filtered(left, keys, "k", "k", "hit")
    assert rows(filtered) == rows(plain) and filtered.where("hit").count() == N / 10
    assert max(shuffled_rows(plain)) == N
    filtered.collect()
    # all hits, and at most one in eight of the other rows (one bit in sixteen is set)
    assert N / 10 <= max(shuffled_rows(filtered)) <= N / 10 + N / 8


def test_filter_is_bounded_and_left_out_beyond(spark, tmpdir_path, monkeypatch):
    left, keys = frames(spark, tmpdir_path, hot=True)
    words, size = joins.key_filter(keys, "k")
    assert size == 16384 and words.count() <= size // 64
    want = rows(joins.exists_flag(left, keys, "k", "k", "hit"))
    monkeypatch.setattr(joins, "FILTER_WORDS", 16)
    assert joins.key_filter(keys, "k") is None
    assert rows(joins.exists_flag_filtered(left, keys, "k", "k", "hit")) == want


def test_empty_sides(spark, tmpdir_path):
    left, keys = frames(spark, tmpdir_path)
    assert joins.exists_flag_filtered(left, keys.limit(0), "k", "k", "hit").where("hit").count() == 0
    assert joins.exists_flag_filtered(left.limit(0), keys, "k", "k", "hit").count() == 0
