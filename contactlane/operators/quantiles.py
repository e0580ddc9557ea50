"""Exact quantiles per group by distributed selection.

Equal values are counted first. The range that holds a wanted rank is narrowed
in rounds: its values fall into ``CELLS`` cells of equal width, and the cell with
the rank becomes the next range, from its least to its greatest *value* -- so one
far outlier costs a round, not precision. A range is narrow enough once it has
at most ``limit`` different values; only those are put in order. Ranges of one
round are narrowed in the same job, for all groups and ranks at once; the driver
only learns whether any is left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import tables

CELLS = 4096
LIMIT = 100_000


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, wanted: Mapping[str, float],
                    limit: int = LIMIT) -> DataFrame:
    """``by...`` and a column for each entry of ``wanted`` (name: share from 0 to 1): the
    smallest value that at least this share of the group's non-NULL values
    doesn't exceed. Groups without values have no row."""
    spark = df.sparkSession
    group = F.struct(*[F.col(c).alias(f"q_{c}") for c in by])
    values, values_path = tables.materialize_at(
        df.where(F.col(value).isNotNull()).select(group.alias("g"), F.col(value).alias("v"))
        .groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")), "quantile-values")
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), F.greatest(
        F.ceil(F.col("n") * F.lit(Decimal(str(share)))).cast("long"), F.lit(1)).alias("rank"))
        for name, share in wanted.items()])
    whole = values.groupBy("g").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"),
                                    F.min("v").alias("lo"), F.max("v").alias("hi"))
    state, path = tables.materialize_at(
        whole.withColumn("r", F.explode(ranks)).select("g", "r.name", "r.rank", "lo", "hi", "d"), "quantile-ranges")
    while not state.where(F.col("d") > limit).isEmpty():
        state, last = _narrowed(values, state, limit), path
        state, path = tables.materialize_at(state, "quantile-ranges")
        tables.remove(spark, last)
    running = Window.partitionBy("g", "lo", "hi").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = _inside(values, state).withColumn("upto", F.sum("c").over(running))
    found = _same_range(ordered, state.select("g", "lo", "hi", "name", "rank")).where(
        F.col("upto") >= F.col("rank")).groupBy("g", "name").agg(F.min("v").alias("v"))
    wide = found.groupBy("g").agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in wanted])
    return wide.select(*[F.col(f"g.q_{c}").alias(c) for c in by], *wanted)


def _inside(values: DataFrame, state: DataFrame) -> DataFrame:
    """Counted values that lie in a range of ``state``, with it."""
    ranges = state.select(F.col("g").alias("g2"), "lo", "hi").distinct()
    return values.join(ranges, F.col("g").eqNullSafe(F.col("g2")) & F.col("v").between(F.col("lo"), F.col("hi"))).drop("g2")


def _same_range(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.select(F.col("g").alias("g2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                         *[c for c in right.columns if c not in ("g", "lo", "hi")])
    same = F.col("g").eqNullSafe(F.col("g2")) & (F.col("lo") == F.col("lo2")) & (F.col("hi") == F.col("hi2"))
    return left.join(other, same).drop("g2", "lo2", "hi2")


def _narrowed(values: DataFrame, state: DataFrame, limit: int) -> DataFrame:
    """``state`` after one round: wide ranges become the cell with their rank."""
    wide = state.where(F.col("d") > limit)
    width = (F.col("hi") - F.col("lo")) / CELLS
    cell = F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(CELLS - 1))
    cells = _inside(values, wide).groupBy("g", "lo", "hi", cell.alias("cell")).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("cd"), F.min("v").alias("clo"), F.max("v").alias("chi"))
    before = Window.partitionBy("g", "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    hit = _same_range(cells, wide.select("g", "lo", "hi", "name", "rank")).where(
        (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n")))
    return state.where(F.col("d") <= limit).unionByName(hit.select(
        "g", "name", (F.col("rank") - F.col("before")).alias("rank"), F.col("clo").alias("lo"),
        F.col("chi").alias("hi"), F.col("cd").alias("d")))
