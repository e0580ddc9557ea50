"""Chat formatting of conversation logs that hold cumulative snapshots.

A log often keeps a conversation again after each turn. Every turn gets the
hash of its conversation up to there (a running sum of hashes that are salted
with the position, so it depends on the order); a conversation whose last hash
is an inner hash of another one is a prefix of it. An anti-join keeps maximal
conversations, the smallest id of equal ones, and only those are rendered.
DataFrame functions only.

Conversations are worked on in sections of ``SECTION`` turns by position, so
turn numbers may be of any kind (counters, epoch seconds). A conversation of at
most ``SECTION`` turns is one section; the turns of longer ones are dealt by
ranges and numbered with the ranges' offsets. Offsets are joined in from the
sections' totals, so that no conversation has to fit in one task; a rendered
conversation of several sections has one row for each, ``part`` 0, 1, ... in
order, which together are its text.

Defined results: NULL roles and texts count as empty; NULL conversation ids
are one conversation; NULL turn numbers come first, in a part of their own; turns with one number are
ordered by role, then text, and a row repeated within a conversation is a turn
of its own; empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import store

SECTION = 4096
NO_NUMBER = -(1 << 62)  # before all others
# The markers of the chat format.
START, END = "<|im_start|>", "<|im_end|>"


def _sectioned(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``conv, turn, role, text``) with ``section``: turns without a
    number (``NO_NUMBER``) apart from the others (0), and the piece of ``SECTION`` rows."""
    rows = rows.withColumn("number", F.when(F.col("turn").isNull(), F.lit(NO_NUMBER)).otherwise(0).cast("long"))
    names = rows.columns
    section = lambda piece: F.struct("number", piece.cast("long").alias("piece")).alias("section")
    own = [c for c in names if c != "number"]
    large = store.stored(rows.groupBy(F.col("conv").alias("conv2"), F.col("number").alias("number2")).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > SECTION).drop("n"), "chat-large")
    if large.isEmpty():
        return rows.select(*own, section(F.lit(0)))
    same = rows["conv"].eqNullSafe(large["conv2"]) & (rows["number"] == large["number2"])
    small = rows.join(large, same, "left_anti").select(*own, section(F.lit(0)))
    # equal rows are one with a count, so that ranges can cut between any two
    counted = rows.join(large, same, "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = store.stored(counted.repartitionByRange("conv", "number", *order).withColumn(
        "range", F.spark_partition_id()), "chat-ranges")
    upto = W.partitionBy("conv", "number", "range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("conv", "number").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = dealt.groupBy("conv", "number", "range").agg(F.sum("copies").alias("n")).select(
        F.col("conv").alias("conv3"), F.col("number").alias("number3"), F.col("range").alias("range3"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = dealt.withColumn("upto", F.sum("copies").over(upto)).join(
        before, F.col("conv").eqNullSafe(F.col("conv3")) & (F.col("number") == F.col("number3"))
        & (F.col("range") == F.col("range3")))
    # positions begin to end - 1, from 0; the copies of each piece, then each copy
    placed = placed.withColumn("end", F.col("upto") + F.col("before")).withColumn(
        "begin", F.col("end") - F.col("copies"))
    whole = lambda c: F.floor(c / SECTION).cast("long")
    placed = placed.withColumn("piece", F.explode(F.sequence(whole(F.col("begin")), whole(F.col("end") - 1))))
    times = F.least("end", (F.col("piece") + 1) * SECTION) - F.greatest("begin", F.col("piece") * SECTION)
    placed = placed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return small.unionByName(placed.select(*own, section(F.col("piece"))))


def _running(df: DataFrame, totals: list[Column], names: list[str]) -> DataFrame:
    """``df`` (with ``conv, section``) joined with the sum of ``totals`` over the
    earlier sections of its conversation."""
    sums = df.groupBy("conv", "section").agg(*[t.alias(n) for t, n in zip(totals, names)])
    earlier = W.partitionBy("conv").orderBy("section").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("conv").alias("conv2"), F.col("section").alias("section2"),
                       *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names])
    return df.join(sums, df["conv"].eqNullSafe(sums["conv2"])
                   & (F.col("section") == F.col("section2"))).drop("conv2", "section2")


def prefix_hashes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """``conv, section, pos, hash1, hash2`` for each turn: its position from 1 and
    the hash of the conversation up to it (two independent halves)."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = _sectioned(turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), empty(role).alias("role"),
                                   empty(text).alias("text"))).withColumn("content", F.sha2("text", 256))
    # ties are ordered by the text itself; only short keys go on from here
    inside = W.partitionBy("conv", "section").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("local", F.row_number().over(inside)).drop("text")
    rows = _running(rows, [F.count(F.lit(1))], ["before"])
    rows = rows.withColumn("pos", F.col("local") + F.col("before")).drop("local", "before", "turn")
    wide = "decimal(38,0)"
    for i in (1, 2):
        rows = rows.withColumn(f"h{i}", F.xxhash64(F.lit(i), "pos", "role", "content").cast(wide))
    upto = W.partitionBy("conv", "section").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.select("conv", "section", "pos", "h1", "h2",
                       F.sum("h1").over(upto).alias("s1"), F.sum("h2").over(upto).alias("s2"))
    rows = _running(rows, [F.sum("h1"), F.sum("h2")], ["b1", "b2"])
    return rows.select("conv", "section", "pos", (F.col("s1") + F.col("b1")).cast(wide).alias("hash1"),
                       (F.col("s2") + F.col("b2")).cast(wide).alias("hash2"))


def maximal(turns: DataFrame, **names: str) -> DataFrame:
    """``conv, n_turns`` of the conversations that are no proper prefix of
    another one; of equal conversations the smallest id (NULL before others)."""
    return _maximal(store.stored(prefix_hashes(turns, **names), "chat-prefixes"))


def _maximal(prefixes: DataFrame) -> DataFrame:
    # the last position is joined by section, so that the turns of one long
    # conversation don't meet in one task
    lasts = prefixes.groupBy("conv", "section").agg(F.max("pos").alias("last"))
    lasts = lasts.select(F.col("conv").alias("conv2"), F.col("section").alias("section2"),
                         F.max("last").over(W.partitionBy("conv")).alias("last"))
    placed = prefixes.join(lasts, F.col("conv").eqNullSafe(F.col("conv2"))
                           & (F.col("section") == F.col("section2"))).drop("conv2", "section2")
    whole = placed.where("pos = last")
    kept = whole.groupBy("pos", "hash1", "hash2").agg(
        F.min("conv").alias("least"), F.max(F.col("conv").isNull()).alias("has_null"))
    kept = kept.select("pos", "hash1", "hash2", F.when(~F.col("has_null"), F.col("least")).alias("conv"))
    inner = placed.where("pos < last").select("pos", "hash1", "hash2").distinct()
    return kept.join(inner, ["pos", "hash1", "hash2"], "left_anti").select(
        "conv", F.col("pos").cast("long").alias("n_turns"))


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn in the chat format; markers inside a text are broken up."""
    safe = lambda c: F.replace(F.replace(c, F.lit(START), F.lit("< |im_start|>")),
                               F.lit(END), F.lit("< |im_end|>"))
    return F.concat(F.lit(START), safe(role), F.lit("\n"), safe(text), F.lit(END + "\n"))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """``conv_id, part, n_turns, rendered`` of the maximal conversations."""
    prefixes = store.stored(prefix_hashes(turns, conv=conv, turn=turn, role=role, text=text), "chat-prefixes")
    kept = _maximal(prefixes)
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = turns.select(F.col(conv).alias("own"), F.col(turn).alias("turn"), empty(role).alias("role"),
                        empty(text).alias("text"))
    rows = rows.join(kept, F.col("own").eqNullSafe(F.col("conv"))).drop("own")
    rows = _sectioned(rows.select("conv", "turn", "role", "text", "n_turns"))
    order = lambda a, b: (
        F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1)
        .when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
        .when(a["turn"] < b["turn"], -1).when(a["turn"] > b["turn"], 1)
        .when(a["role"] < b["role"], -1).when(a["role"] > b["role"], 1)
        .when(a["text"] < b["text"], -1).when(a["text"] > b["text"], 1).otherwise(0))
    parts = rows.groupBy("conv", "section", "n_turns").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text")), order).alias("turns"))
    # parts are numbered apart from their texts
    number = F.row_number().over(W.partitionBy("conv").orderBy("section")) - 1
    numbers = prefixes.select("conv", "section").distinct().select(
        F.col("conv").alias("conv4"), F.col("section").alias("section4"), number.cast("long").alias("part"))
    parts = parts.join(numbers, F.col("conv").eqNullSafe(F.col("conv4")) & (F.col("section") == F.col("section4")))
    return parts.select(F.col("conv").alias("conv_id"), "part", "n_turns",
                        F.array_join(F.transform("turns", lambda t: rendered_turn(t["role"], t["text"])), "")
                        .alias("rendered"))
