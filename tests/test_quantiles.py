"""Exact quantiles against sorted lists, with heavy tails and narrow limits."""
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from contactlane.operators import quantiles as Qn
from contactlane.plans import queries as QS

WANTED = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}


def plain(values, share):
    values = sorted(values)
    return values[max(math.ceil(round(share * len(values), 9)), 1) - 1]


@pytest.mark.parametrize("limit", [1, 7, 100_000])
def test_equals_sorted_lists(spark, limit):
    rnd = random.Random(limit)
    own = {"even": [float(i) for i in range(500)], "tail": [rnd.random() for _ in range(400)] + [1e6, 1e12],
           "powers": [2.0 ** i for i in range(-200, 200)], "equal": [3.5] * 300, "few": [-1.0, 2.0],
           None: [float(rnd.randint(0, 30)) for _ in range(200)], "below": [-(10.0 ** (i % 40)) for i in range(90)]}
    rows = [(g, i % 2, v) for g, values in own.items() for i, v in enumerate(values)] + [("even", 0, None), ("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, side int, v double").repartition(3)
    got = {r["g"]: r for r in Qn.exact_quantiles(df, ["g"], "v", WANTED, limit).collect()}
    assert set(got) == set(own)
    for g, values in own.items():
        assert {k: got[g][k] for k in WANTED} == {k: plain(values, s) for k, s in WANTED.items()}, g
    two = Qn.exact_quantiles(df, ["g", "side"], "v", {"m": 0.5}, limit)
    assert {(r["g"], r["side"]): r["m"] for r in two.collect()} == {
        (g, s): plain(values[s::2], 0.5) for g, values in own.items() for s in (0, 1) if values[s::2]}


def test_no_task_orders_more_than_the_limit(spark, monkeypatch):
    """One outlier of a million times the median: all other values share the first cell."""
    df = spark.range(5000).select(F.lit("g").alias("g"), F.when(F.col("id") == 0, 2.5e9).otherwise(
        F.col("id").cast("double")).alias("v"))
    sizes, narrowed, rounds = [], Qn._narrowed, []
    inside = Qn._inside

    def watched(values, state):
        rows = inside(values, state)
        sizes.append(rows.groupBy("g", "lo", "hi").count().agg(F.max("count")).first()[0])
        return rows

    monkeypatch.setattr(Qn, "_inside", watched)
    monkeypatch.setattr(Qn, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    row = Qn.exact_quantiles(df, ["g"], "v", {"p50": 0.5, "p99": 0.99}, limit=20).collect()[0]
    values = sorted([2.5e9, *map(float, range(1, 5000))])
    assert (row["p50"], row["p99"]) == (plain(values, 0.5), plain(values, 0.99))
    assert len(rounds) == 2 and sizes[-1] <= 20                   # the last one is what gets ordered


def test_whole_numbers_and_empty_tables(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("g"), "id")
    got = {r["g"]: r["m"] for r in Qn.exact_quantiles(df, ["g"], "id", {"m": 0.5}, limit=9).collect()}
    assert got == {g: plain(range(g, 1000, 10), 0.5) for g in range(10)}
    assert Qn.exact_quantiles(df.limit(0), ["g"], "id", {"m": 0.5}).count() == 0


def test_turnaround_reads_its_inputs_once(spark):
    plan = QS.turnaround_quantiles(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "events.parquet" not in plan
