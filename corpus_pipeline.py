"""Training-corpus pipeline: five stages over ``documents``.

``STAGES`` lists ``(name, function)``; each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``; the functions are those of ``contactlane.llm.stages``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contactlane.llm import store
from contactlane.llm.stages import (drop_low_quality, encode_tokens, mix_sources, one_of_near_duplicates,
                                    redact_pii)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", drop_low_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

# SQL can't express the fitted classifier nor the tokenizer's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = None
    for name, stage in STAGES:
        with store.scope(spark) as temporary:
            docs, path = store.stored_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
            temporary.discard(path)
        if done:
            store.remove(spark, done)
        done = path
    return docs
