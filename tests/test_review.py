"""Intake and review jobs that write tables: counts, idempotent reruns, outputs."""
import json
import os

from pyspark.sql import functions as F

from conftest import SF001, SF01
from contactlane.operators import decisions as D
from contactlane.plans import intake
from contactlane.plans import queries as QS
from contactlane.sources import fixtures as fx
from contactlane.sources import schemas, tables


def test_run_intake_writes_queue_and_counts(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "review_queue")
    counts = intake.run_intake(fx.emails(spark, SF001), QS.directory(spark, SF001), path,
                               QS.as_of(), materialize_extraction=True)
    assert counts["rows"] == 150 == counts["PASS"] + counts["NEEDS_REVIEW"] + counts["FAIL"]
    assert counts["FAIL"] == 113
    q = tables.read_queue(spark, path)
    assert q.schema.names == schemas.REVIEW_QUEUE.names
    assert q.count() == 150
    assert sorted(d for d in os.listdir(path) if d.startswith("queue_type=")) == [
        "queue_type=detailed_review", "queue_type=quick_approval", "queue_type=rejected"]
    view = q.where("queue_type = 'quick_approval'")
    assert "PartitionFilters: [isnotnull(queue_type" in view._jdf.queryExecution().toString()
    assert view.count() == counts["PASS"]


def test_run_review_is_idempotent(spark, tmpdir_path):
    db = "review_" + os.path.basename(tmpdir_path).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tables.ensure_tables(spark, tmpdir_path, database=db)
    tables.ensure_tables(spark, tmpdir_path, database=db)      # second call is a no-op
    queue = QS.queue_extracted(spark, SF001)
    emails = fx.emails(spark, SF001)
    names = {k: f"{db}.{k}" for k in ("approved_changes", "outgoing_emails", "review_actions")}
    first = intake.run_review(queue, emails, "rev@example.com", QS.as_of(),
                              names["approved_changes"], names["outgoing_emails"],
                              names["review_actions"])
    n = first["confirm"]
    assert n > 20 and first == {"confirm": n, "followup": 150 - n}
    approved = spark.table(names["approved_changes"])
    outgoing = spark.table(names["outgoing_emails"])
    actions = spark.table(names["review_actions"])
    assert approved.count() == n and outgoing.count() == 150 - n and actions.count() == 150
    # approved ∪ outgoing = decided, disjoint
    assert approved.join(outgoing, "email_id").count() == 0
    second = intake.run_review(queue, emails, "rev@example.com", QS.as_of(),
                               names["approved_changes"], names["outgoing_emails"],
                               names["review_actions"])
    assert second == {}
    assert spark.table(names["review_actions"]).count() == 150
    assert spark.table(names["approved_changes"]).count() == n
    row = actions.where(F.col("action") == "confirmed").orderBy("email_id").first()
    assert set(json.loads(row["new_values"])) == {"sap_id", "contact_name", "contact_email",
                                                  "contact_phone"}
    fu = actions.where(F.col("action") == "followup_sent").orderBy("email_id").first()
    old = json.loads(fu["old_values"])
    assert old["missing_fields"] and set(old["missing_fields"][0]) == {"field", "error"}
    assert json.loads(fu["new_values"])["followup_email"]["subject"] == D.DEFAULT_TEMPLATE.subject
    assert fu["reason"] == "Missing or invalid fields"


def test_followup_text(spark):
    rows = [("e1", "s@x.org", "  JOHN  SMITH ", None, "sap1", [("SAP ID", "x.y", "bad id")]),
            ("e2", "t@x.org", "   ", "SAP000001", "SAP000001", []),
            ("e3", "u@x.org", None, None, None, [])]
    df = spark.createDataFrame(rows, "email_id string, sender string, contact_name string, "
                                     "normalized_sap_id string, sap_id string, "
                                     "issues array<struct<field:string,code:string,error:string>>")
    out = {r["email_id"]: r["message_body"] for r in D.followup_message(df).collect()}
    assert out["e1"].startswith("Hello JOHN,\n") and "account sap1." in out["e1"]
    assert "  - SAP ID: bad id" in out["e1"]
    assert out["e2"].startswith("Hello there,") and "account SAP000001." in out["e2"]
    assert "account [your account]." in out["e3"]


def test_merge_corrections(spark):
    recs = spark.createDataFrame([("e1", "SAP1", "a b", "x@y.co", "1"), ("e2", "SAP2", "c d", None, "2")],
                                 "email_id string, sap_id string, contact_name string, "
                                 "contact_email string, contact_phone string")
    edits = spark.createDataFrame([("e1", None, "", "new@y.co", None)],
                                  "email_id string, sap_id string, contact_name string, "
                                  "contact_email string, contact_phone string")
    out = {r["email_id"]: r for r in D.merge_corrections(recs, edits).collect()}
    assert out["e1"]["contact_email"] == "new@y.co" and out["e1"]["contact_name"] == "a b"
    assert out["e1"]["changed_fields"] == ["contact_email"]
    assert out["e2"]["changed_fields"] == [] and out["e2"]["contact_email"] is None


def test_directory_refresh_and_csv_export(spark, tmpdir_path):
    from contactlane.operators import audit as A

    path = os.path.join(tmpdir_path, "directory")
    n = intake.run_directory_refresh(fx.emails(spark, SF001).select("sap_id"), path, QS.as_of())
    d = spark.read.parquet(path)
    assert n == d.count() and d.schema.names == schemas.DIRECTORY.names
    assert d.where(F.col("account_status") != "ACTIVE").count() == 0
    out = os.path.join(tmpdir_path, "audit_csv")
    A.export_audit_log(fx.actions(spark, SF001), out, limit=20, tie=("event_id",))
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 20 and back.columns == ["email_id", "action", "actor_email",
                                                   "created_at", "reason"]
    assert {r.action for r in back.collect()} <= {"✅ Confirmed", "📤 Follow-up Sent", "view", "click", "signup"}


def test_ordered_sample(spark):
    ext = intake.extracted(fx.emails(spark, SF001), sample=10)
    ids = [r[0] for r in ext.select("email_id").collect()]
    assert sorted(ids) == [f"EMAIL-{i:08d}" for i in range(10)]


def test_run_review_completes_after_partial_failure(spark, tmpdir_path):
    """A run that stopped after the approved rows were appended: the re-run adds the
    missing outgoing and audit rows and no second approved row."""
    db = "partial_" + os.path.basename(tmpdir_path).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tables.ensure_tables(spark, tmpdir_path, database=db)
    names = {k: f"{db}.{k}" for k in ("approved_changes", "outgoing_emails", "review_actions")}
    queue = QS.queue_extracted(spark, SF001)
    emails = fx.emails(spark, SF001)
    dec = intake.decisions(queue, spark.table(names["review_actions"]))
    tables.append(intake.approved(dec, emails, "rev@example.com", QS.as_of()), names["approved_changes"],
                  schemas.APPROVED_CHANGES)                       # ... then the run stopped
    n = spark.table(names["approved_changes"]).count()
    assert n > 20
    intake.run_review(queue, emails, "rev@example.com", QS.as_of(), names["approved_changes"],
                      names["outgoing_emails"], names["review_actions"])
    approved = spark.table(names["approved_changes"])
    assert approved.count() == n and approved.select("email_id").distinct().count() == n
    assert spark.table(names["outgoing_emails"]).count() == 150 - n
    assert spark.table(names["review_actions"]).count() == 150


def test_lookup_issue_option(spark):
    from contactlane.operators import queue as Q

    pend = Q.pending(QS.queue_extracted(spark, SF001), fx.actions(spark, SF001))
    plain = D.decide(pend).where("validation_status = 'NEEDS_REVIEW'").collect()
    assert plain and all(r.decision == "followup" and r.issues == [] for r in plain)
    flagged = D.decide(pend, include_lookup_issue=True).where(
        "validation_status = 'NEEDS_REVIEW'").collect()
    assert all([(i.field, i.code) for i in r.issues] == [("SAP ID", "sap_id.unknown")]
               for r in flagged)


def test_action_log_partitioned_by_date(spark, tmpdir_path):
    from contactlane.operators import audit as A

    db = "dated_" + os.path.basename(tmpdir_path).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tables.ensure_tables(spark, tmpdir_path, database=db)
    acts = fx.actions(spark, SF001)
    tables.append(acts.select("email_id", "action", "actor_email",
                              F.lit(None).cast("string").alias("old_values"),
                              F.lit(None).cast("string").alias("new_values"), "reason",
                              "created_at"), f"{db}.review_actions", schemas.REVIEW_ACTIONS)
    log = spark.table(f"{db}.review_actions")
    assert log.count() == acts.count() == 1000
    days = [d for d in os.listdir(os.path.join(tmpdir_path, "review_actions"))
            if d.startswith("action_date=")]
    assert len(days) > 10
    since = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    pruned = A.new_since(log, "created_at", since, ["action"], date_partition="action_date")
    plan = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(action_date" in plan
    plain = A.new_since(acts, "created_at", since, ["action"])
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, plain.collect()))


def _tables(spark, folder, prefix):
    db = prefix + "_" + os.path.basename(folder).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tables.ensure_tables(spark, folder, database=db)
    return [f"{db}.{k}" for k in ("approved_changes", "outgoing_emails", "review_actions")]


def _counts(spark, names):
    return [spark.table(n).count() for n in names]


def test_rerun_with_null_and_repeated_ids_adds_nothing(spark, tmpdir_path):
    """One decision per id (its latest row); rows without an id are reported."""
    names = _tables(spark, tmpdir_path, "dup")
    queue = QS.queue_extracted(spark, SF001)
    good = queue.where("validation_status = 'PASS'").orderBy("email_id").limit(2)
    bad = queue.where("validation_status = 'FAIL'").orderBy("email_id").limit(2)
    later = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    first_id, second_id = [r.email_id for r in good.collect()]
    again = bad.limit(1).withColumns({"email_id": F.lit(first_id), "queued_at": later})
    nameless = good.withColumn("email_id", F.lit(None).cast("string"))
    rows = tables.materialize(good.union(good).union(again).union(nameless).union(nameless), "odd-queue")
    emails = fx.emails(spark, SF001)
    one = intake.run_review(rows, emails, "r@example.com", QS.as_of(), *names)
    assert one == {"confirm": 1, "followup": 1, "no_id": 4}
    assert _counts(spark, names) == [1, 1, 2]
    assert spark.table(names[1]).first().email_id == first_id      # its latest row is the failed one
    assert spark.table(names[0]).first().email_id == second_id
    two = intake.run_review(rows, emails, "r@example.com", QS.as_of(), *names)
    assert two == {"no_id": 4} and _counts(spark, names) == [1, 1, 2]


def test_chosen_items_actors_and_edited_text(spark, tmpdir_path):
    names = _tables(spark, tmpdir_path, "chosen")
    queue = QS.queue_extracted(spark, SF001)
    fail = [r.email_id for r in queue.where("validation_status = 'FAIL'").orderBy("email_id").limit(2).collect()]
    ok = [r.email_id for r in queue.where("validation_status = 'PASS'").orderBy("email_id").limit(1).collect()]
    chosen = spark.createDataFrame(
        [(fail[0], "ann@x", "My subject", "My text"), (fail[1], None, "", None), (ok[0], "bob@x", None, None),
         ("unknown", "eve@x", None, None), (None, "eve@x", None, None)],
        "email_id string, actor string, subject string, body string")
    got = intake.run_review(queue, fx.emails(spark, SF001), "default@x", QS.as_of(), *names, chosen=chosen)
    assert got == {"confirm": 1, "followup": 2}
    out = {r.email_id: r for r in spark.table(names[1]).collect()}
    assert (out[fail[0]].subject, out[fail[0]].body, out[fail[0]].created_by) == ("My subject", "My text", "ann@x")
    assert out[fail[1]].subject == D.DEFAULT_TEMPLATE.subject and out[fail[1]].created_by == "default@x"
    assert spark.table(names[0]).first().approved_by == "bob@x"
    log = {r.email_id: r for r in spark.table(names[2]).collect()}
    assert json.loads(log[fail[0]].new_values)["followup_email"]["subject"] == "My subject"
    rest = intake.run_review(queue, fx.emails(spark, SF001), "default@x", QS.as_of(), *names)
    assert sum(rest.values()) == 147                                # the others were left pending


def test_auto_approval(spark, tmpdir_path):
    names = _tables(spark, tmpdir_path, "auto")
    db = names[0].split(".")[0]
    queue, emails = QS.queue_extracted(spark, SF001), fx.emails(spark, SF001)
    n = intake.run_auto_approval(queue, emails, "auto", QS.as_of(), f"{db}.auto_approved", names[2])
    assert n == queue.where("validation_status = 'PASS'").count() == spark.table(f"{db}.auto_approved").count()
    assert {r.action for r in spark.table(names[2]).select("action").distinct().collect()} == {"auto_approved"}
    assert intake.run_auto_approval(queue, emails, "auto", QS.as_of(), f"{db}.auto_approved", names[2]) == 0
    assert spark.table(f"{db}.auto_approved").count() == n
    assert QS.auto_approved(spark, SF01).count() < QS.corrected_approvals(spark, SF01).count()


def test_latest_edit_wins(spark):
    import datetime as dt

    recs = spark.createDataFrame([("e1", "SAP1", "a b", "x@y.co", "1")], "email_id string, sap_id string, "
                                 "contact_name string, contact_email string, contact_phone string")
    edits = spark.createDataFrame(
        [("e1", "SAP9", "z z", None, "", dt.datetime(2024, 1, 1)), ("e1", "SAP5", None, None, None, dt.datetime(2024, 1, 2))],
        "email_id string, sap_id string, contact_name string, contact_email string, contact_phone string, at timestamp")
    r = D.merge_corrections(recs, edits, ts="at").first()
    assert (r.sap_id, r.contact_name, r.contact_email, r.contact_phone) == ("SAP5", "z z", "x@y.co", "1")
