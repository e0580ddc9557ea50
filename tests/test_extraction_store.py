"""Extraction results are kept by body: what is called, retried and given up."""
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from contactlane.operators import extract as X
from contactlane.plans import extraction_store as E
from contactlane.sources import fixtures as fx
from contactlane.sources.runs import RunStore

TABLES = {E.RESULTS: E.RESULT_TABLE}
SCHEMA = "email_id string, body string"


def counting(spark, fails=()):
    """An extractor that counts the bodies it is sent; those in ``fails`` get an error."""
    seen = spark.sparkContext.accumulator(0)

    def extract(bodies: pd.Series) -> pd.DataFrame:
        seen.add(len(bodies))
        return pd.DataFrame({"sap_id": bodies.str.upper(), "contact_name": None,
                             "extraction_error": bodies.map(lambda b: "busy" if b in fails else None)})
    return extract, seen


def fields(store, emails, **more):
    return {r["email_id"]: (r["sap_id"], r["extraction_error"], r["attempts"])
            for r in E.with_results(store, emails, **more).collect()}


def test_equal_bodies_once_and_known_ones_never(spark, tmpdir_path):
    store = RunStore(spark, tmpdir_path, TABLES)
    # a third of the messages are one out-of-office note
    rows = [(f"e{i}", f"body {i % 40}") for i in range(60)] + [(f"o{i}", "out of office") for i in range(30)]
    rows += [(None, "body 1"), ("n", None), ("z", "")]
    emails = spark.createDataFrame(rows, SCHEMA).repartition(4)
    extract, seen = counting(spark)
    assert E.run_extraction(store, emails, extract) == {"extracted": 42, "failed": 0, "commit": 1}
    assert seen.value == 42
    assert E.run_extraction(store, emails, extract) == {} and seen.value == 42
    got = fields(store, emails)
    assert got["o3"] == ("OUT OF OFFICE", None, 1) and got["e41"] == got[None] == ("BODY 1", None, 1)
    assert got["n"] == (None, X.NO_RESPONSE, 0) and got["z"] == ("", None, 1)
    assert E.with_results(store, emails).count() == len(rows)
    more = emails.union(spark.createDataFrame([("x", "new one")], SCHEMA))
    assert fields(store, more)["x"] == (None, E.NOT_EXTRACTED, 0)
    assert E.run_extraction(store, more, extract)["extracted"] == 1 and seen.value == 43
    assert fields(store, more)["x"] == ("NEW ONE", None, 1)
    assert fields(store, more, upto=1)["x"] == (None, E.NOT_EXTRACTED, 0)
    # another version of the extractor has results of its own
    assert E.run_extraction(store, more, extract, version="2")["extracted"] == 43 and seen.value == 86


def test_failed_bodies_are_tried_again_and_then_given_up(spark, tmpdir_path):
    store = RunStore(spark, tmpdir_path, TABLES)
    emails = spark.createDataFrame([("a", "good"), ("b", "bad"), ("c", "worse"), ("d", "bad")], SCHEMA)
    first, one = counting(spark, fails=("bad", "worse"))
    assert E.run_extraction(store, emails, first, max_attempts=3) == {"extracted": 1, "failed": 2, "commit": 1}
    assert fields(store, emails) == {"a": ("GOOD", None, 1), "b": ("BAD", "busy", 1), "c": ("WORSE", "busy", 1),
                                     "d": ("BAD", "busy", 1)}
    second, two = counting(spark, fails=("worse",))
    assert E.run_extraction(store, emails, second, max_attempts=3) == {"extracted": 1, "failed": 1, "commit": 2}
    assert (one.value, two.value) == (3, 2) and fields(store, emails)["d"] == ("BAD", None, 2)
    assert E.dead_letters(store, "1", max_attempts=3).count() == 0
    third, three = counting(spark, fails=("worse",))
    E.run_extraction(store, emails, third, max_attempts=3)
    assert three.value == 1
    assert [(r["attempts"], r["extraction_error"]) for r in E.dead_letters(store, "1", max_attempts=3).collect()] == [
        (3, "busy")]
    assert E.run_extraction(store, emails, third, max_attempts=3) == {} and three.value == 1


def test_plain_join_beyond_the_broadcast_bound(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(E, "BROADCAST_HASHES", 0)
    store, emails = RunStore(spark, tmpdir_path, TABLES), fx.emails(spark, SF001).select("email_id", "sender", "body")
    extract, seen = counting(spark)
    assert E.run_extraction(store, emails, extract)["extracted"] == seen.value
    assert seen.value == emails.select("body").distinct().count()
    assert E.with_results(store, emails).where("attempts <> 1").count() == 0


def test_empty_input_and_a_failing_run(spark, tmpdir_path):
    store = RunStore(spark, tmpdir_path, TABLES)
    emails = spark.createDataFrame([("a", "x")], SCHEMA)
    extract, seen = counting(spark)
    assert E.run_extraction(store, emails.limit(0), extract) == {} and store.last() == 0
    broken = emails.withColumn("body", F.raise_error(F.lit("bad file")).cast("string"))
    with pytest.raises(Exception, match="bad file"):
        E.run_extraction(store, broken, extract)
    assert store.last() == 0 and store.clean(older_than_s=-1) == 0 and seen.value == 0


def test_calls_are_dealt_over_the_cluster(spark, tmpdir_path):
    store, emails = RunStore(spark, tmpdir_path, TABLES), fx.emails(spark, SF001).select("email_id", "sender", "body")
    calls = spark.sparkContext.accumulator(0)

    def extract(bodies: pd.Series) -> pd.DataFrame:
        calls.add(1)
        return pd.DataFrame({"sap_id": bodies})
    assert E.run_extraction(store, emails, extract)["failed"] == 0
    # small as they are, the bodies aren't put together in one task
    assert calls.value == X.call_tasks(spark) == 4
