"""Expected counts of FIXTURES.md §3 and invariants of the intake and review jobs."""
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from contactlane.operators import directory as Dir
from contactlane.operators import extract as X
from contactlane.operators import queue as Q
from contactlane.operators import routing as G
from contactlane.plans import intake
from contactlane.plans import queries as QS
from contactlane.sources import fixtures as fx

EXPECTED = {
    SF001: {"fields": 150, "directory": 145, "actions": (1000, 15), "direct": (99, 1, 50),
            "direct_flags": (111, 114, 123, 118, 106), "direct_pending": (94, 1, 40, 135),
            "extracted": (113, 1, 36), "extracted_flags": (74, 76, 82, 79, 70),
            "extracted_pending": (105, 1, 29, 135), "documents": 5},
    SF01: {"fields": 1500, "directory": 1429, "actions": (10000, 150), "direct": (936, 25, 539),
           "direct_flags": (1125, 1153, 1234, 1184, 1070), "direct_pending": (837, 23, 490, 1350),
           "extracted": (1122, 16, 362), "extracted_flags": (750, 769, 822, 790, 714),
           "extracted_pending": (1009, 15, 326, 1350), "documents": 11},
}
FLAGS = ("sap_id_valid", "name_valid", "email_valid", "phone_valid", "sap_exists")


def status_counts(df):
    got = {r["validation_status"]: r["n"] for r in
           df.groupBy("validation_status").agg(F.count(F.lit(1)).alias("n")).collect()}
    return tuple(got.get(s, 0) for s in ("FAIL", "NEEDS_REVIEW", "PASS"))


def flag_counts(df):
    r = df.agg(*[F.count_if(F.col(f)).alias(f) for f in FLAGS]).collect()[0]
    return tuple(r[f] for f in FLAGS)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_fixture_counts(spark, sf):
    exp = EXPECTED[sf]
    assert fx.fields(spark, sf).count() == exp["fields"]
    assert QS.directory(spark, sf).count() == exp["directory"]
    acts = fx.actions(spark, sf)
    assert (acts.count(), acts.select("email_id").distinct().count()) == exp["actions"]
    direct = QS.routed_direct(spark, sf)
    assert status_counts(direct) == exp["direct"]
    assert flag_counts(direct) == exp["direct_flags"]
    ext = intake.routed(intake.extracted(fx.emails(spark, sf)), QS.directory(spark, sf))
    assert status_counts(ext) == exp["extracted"]
    assert flag_counts(ext) == exp["extracted_flags"]
    for queue, key in ((QS.queue_direct(spark, sf), "direct_pending"),
                       (QS.queue_extracted(spark, sf), "extracted_pending")):
        k = Q.kpi_counts(Q.pending(queue, acts)).collect()[0]
        assert (k["fail"], k["needs_review"], k["pass"], k["total"]) == exp[key]
    assert X.document_addresses(fx.documents(spark, sf)).count() == exp["documents"]


def test_invariants(spark):
    sf = SF001
    fields = fx.fields(spark, sf)
    routed = QS.routed_direct(spark, sf)
    assert routed.count() == fields.count()                     # row count preserved
    assert routed.select("email_id").distinct().count() == fields.count()
    queues = routed.groupBy("email_id").agg(F.count_distinct("queue_type").alias("k"))
    assert queues.where("k <> 1").count() == 0                  # exactly one queue each
    pairs = {(r[0], r[1]) for r in routed.select("validation_status", "queue_type").distinct().collect()}
    assert pairs <= {(s, G.QUEUE_OF[s]) for s in G.QUEUE_OF}
    queue = QS.queue_direct(spark, sf)
    acts = fx.actions(spark, sf)
    pend = Q.pending(queue, acts)
    assert pend.join(acts, "email_id", "left_semi").count() == 0  # pending ∩ actioned = ∅
    assert pend.count() + queue.join(acts, "email_id", "left_semi").count() == queue.count()


def test_null_keys_kept_and_not_found(spark):
    rows = [("e1", "SAP000001"), (None, "SAP000002"), ("e3", None), (None, None)]
    df = spark.createDataFrame(rows, "email_id string, normalized_sap_id string")
    directory = spark.createDataFrame([("SAP000001",), ("SAP000001",), (None,)], "sap_id string")
    acts = spark.createDataFrame([("e1",), (None,)], "email_id string")
    for threshold in ("10MB", "-1"):                           # AQE may broadcast, or not
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        out = {(r[0], r[1]): r[2] for r in Dir.with_directory_flag(df, directory).collect()}
        assert out == {("e1", "SAP000001"): True, (None, "SAP000002"): False,
                       ("e3", None): False, (None, None): False}
        assert sorted((r[0] or "", r[1] or "") for r in Q.pending(df, acts).collect()) == [
            ("", ""), ("", "SAP000002"), ("e3", "")]
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_search_semantics(spark):
    rows = [("EMAIL-1", "a@x", None, None), ("EMAIL-2", "b@x", "SAP1%", "SAP100001"),
            ("EMAIL-3", "c@x", "sap1x", None)]
    df = spark.createDataFrame(rows, "email_id string, sender string, sap_id string, normalized_sap_id string")

    def ids(q, mode="contains"):
        cond = Q.search_filter(q, mode)
        return sorted(r[0] for r in (df.where(cond) if cond is not None else df).collect())
    assert ids("") == ["EMAIL-1", "EMAIL-2", "EMAIL-3"]
    assert ids("SAP1%") == ["EMAIL-2"]                         # literal by default
    assert ids("SAP1%", "like") == ["EMAIL-2"]                 # % is a wildcard in like mode
    assert ids("SAP1_", "like") == ["EMAIL-2"]
    assert ids("sap") == ["EMAIL-3"]                           # case-sensitive
    assert ids("EMAIL-1") == ["EMAIL-1"]                       # NULL columns don't hide a hit


def test_labels_fall_back_under_ansi(spark):
    from contactlane.operators import audit as A

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("PASS",), ("WEIRD",)], "validation_status string")
    got = {r.validation_status: r for r in Q.status_labels(df).collect()}
    assert got["PASS"].status_display == "✅ PASS" and got["PASS"].badge_title == "Complete"
    assert got["WEIRD"].status_display == " WEIRD" and got["WEIRD"].badge_title == "Incomplete"
    acts = spark.createDataFrame([("confirmed",), ("followup_sent",), ("other",)], "action string")
    labels = [r.a for r in acts.select(A.action_label(F.col("action")).alias("a")).collect()]
    assert labels == ["✅ Confirmed", "📤 Follow-up Sent", "other"]
