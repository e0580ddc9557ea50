"""Extraction results kept by the text they were extracted from.

A body is known by its SHA-256 and the extractor's version. A run collapses the
messages to distinct hashes, leaves out those with a result, and calls the
extractor once for each body that is left -- so a second run over the same
messages calls it for none, and equal bodies cost one call. Results are appended
in one commit per run. A body the extractor failed on keeps its error and is
tried again by later runs until ``max_attempts``; after that it is a dead letter.

NULL bodies are never sent to the extractor. Two runs at once may both pay for a
body that neither has a result for yet; readers see one result (the one of the
last attempt, the largest of several of equal attempt).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import extract as X
from ..sources import tables
from ..sources.runs import Run, RunStore, RunTable, attempt
from . import joins

S = T.StringType()
_FIELDS = [*X.EXTRACTION_FIELDS, "extraction_error"]
RESULTS = "extractions"
RESULT_TABLE = RunTable(T.StructType([T.StructField("body_hash", S), T.StructField("version", S),
                                      T.StructField("attempts", T.IntegerType())]
                                     + [T.StructField(f, S) for f in _FIELDS]))
NOT_EXTRACTED = "not_extracted"
# Up to so many new hashes (of 64 characters) are sent to every executor, beyond
# that the bodies are shuffled to them.
BROADCAST_HASHES = 200_000


def body_hash(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def latest(results: DataFrame, version: str) -> DataFrame:
    """One row per body: that of its last attempt."""
    best = F.max(F.struct("attempts", *_FIELDS)).alias("_r")
    return (results.where(F.col("version") == version).groupBy("body_hash").agg(best)
            .select("body_hash", "_r.*"))


def dead_letters(store: RunStore, version: str, max_attempts: int = 3) -> DataFrame:
    """Bodies (by hash) that the extractor failed on ``max_attempts`` times."""
    return latest(store.read(RESULTS), version).where(
        F.col("extraction_error").isNotNull() & (F.col("attempts") >= max_attempts)).select(
        "body_hash", "attempts", "extraction_error")


def new_bodies(emails: DataFrame, known: DataFrame, max_attempts: int, body: str = "body") -> tuple[DataFrame, str]:
    """``body_hash, body, tried``: one row for each distinct body without a result,
    with its failed attempts so far. Also gives the folder of the new hashes."""
    open_ = known.where(F.col("extraction_error").isNotNull() & (F.col("attempts") < max_attempts))
    settled = known.where(F.col("extraction_error").isNull() | (F.col("attempts") >= max_attempts))
    hashed = emails.where(F.col(body).isNotNull()).select(body_hash(F.col(body)).alias("body_hash"), F.col(body).alias("body"))
    wanted = hashed.select("body_hash").distinct().join(settled.select("body_hash"), "body_hash", "left_anti")
    tried = open_.select(F.col("body_hash").alias("_h"), F.col("attempts").alias("tried"))
    wanted = wanted.join(tried, F.col("body_hash") == F.col("_h"), "left").select("body_hash", F.coalesce("tried", F.lit(0)).alias("tried"))
    wanted, path = tables.materialize_at(wanted, "new-hashes")
    n = wanted.count()
    side = F.broadcast(wanted) if n <= BROADCAST_HASHES else wanted
    # the join comes first: of known bodies nothing is aggregated or moved
    return hashed.join(side, "body_hash").groupBy("body_hash").agg(
        F.min("body").alias("body"), F.first("tried").alias("tried")), path


def run_extraction(store: RunStore, emails: DataFrame, extractor: Callable[[pd.Series], pd.DataFrame],
                   version: str = "1", max_attempts: int = 3, body: str = "body") -> dict[str, int]:
    """Call the extractor for the bodies without a result. Numbers of bodies
    ``extracted`` and ``failed`` and the ``commit``; ``{}`` where all are known."""
    counts: dict[str, int] = {}

    def work(run: Run) -> int | None:
        counts.clear()
        bodies, path = new_bodies(emails, latest(run.read(RESULTS), version), max_attempts, body)
        try:
            if store.spark.read.parquet(path).isEmpty():
                return None
            # dealt by number: by their hash, small bodies would be put together in few tasks
            out = X.extract_with(bodies.repartition(X.call_tasks(store.spark)), extractor).select(
                "body_hash", F.lit(version).alias("version"), (F.col("tried") + 1).alias("attempts"), *_FIELDS)
            run.write(RESULTS, out)
        finally:
            tables.remove(store.spark, path)
        failed = F.col("extraction_error").isNotNull()
        counts.update(run.own(RESULTS).agg(F.count_if(~failed).alias("extracted"),
                                           F.count_if(failed).alias("failed")).first().asDict())
        return run.commit()

    number = attempt(store, "extraction", work)
    return counts | {"commit": number} if number else {}


def with_results(store: RunStore, emails: DataFrame, version: str = "1", body: str = "body",
                 upto: int | None = None) -> DataFrame:
    """Every message with the stored fields of its body, ``extraction_error`` and
    ``attempts``. A body without a result has the error ``not_extracted``."""
    found = latest(store.read(RESULTS, upto), version).withColumnRenamed("body_hash", "_x_hash")
    kept = emails.drop(*_FIELDS, "attempts").withColumn("_x_body", body_hash(F.col(body)))
    out = joins.lookup(kept, found.withColumn("_x_hit", F.lit(True)), "_x_body", "_x_hash")
    error = (F.when(F.col(body).isNull(), F.lit(X.NO_RESPONSE)).when(F.col("_x_hit").isNull(), F.lit(NOT_EXTRACTED))
             .otherwise(F.col("extraction_error")))
    plain = F.col("_x_hit").isNull()
    return out.withColumns({
        "extraction_error": error, "attempts": F.coalesce("attempts", F.lit(0)),
        "request_type": F.when(plain, F.lit(X.DEFAULT_REQUEST_TYPE)).otherwise(F.col("request_type"))}).drop(
        "_x_body", "_x_hit")
