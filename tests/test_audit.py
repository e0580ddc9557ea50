"""Audit reports on literal data: total orders, per-key picks, turnaround."""
import datetime as dt

from pyspark.sql import functions as F

from contactlane.operators import audit as A
from contactlane.operators import decisions as D

T0 = dt.datetime(2024, 1, 1)


def ts(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def actions_df(spark):
    rows = [("e1", "confirmed", "a@x", None, ts(10), 1),
            ("e1", "followup_sent", "b@x", "r", ts(10), 2),      # same time: tie-break decides
            ("e2", "followup_sent", "c@x", "r", ts(5), 3),
            ("e2", "confirmed", "d@x", None, ts(30), 4),
            ("e3", "weird", "e@x", None, ts(1), 5)]
    return spark.createDataFrame(rows, "email_id string, action string, actor_email string, "
                                       "reason string, created_at timestamp_ntz, event_id long")


def test_audit_log_total_order_and_labels(spark):
    rows = A.audit_log(actions_df(spark), limit=3, tie=("event_id",)).collect()
    assert [(r.email_id, r.action) for r in rows] == [
        ("e2", "✅ Confirmed"), ("e1", "📤 Follow-up Sent"), ("e1", "✅ Confirmed")]


def test_latest_and_first_per_key(spark):
    latest = {r.email_id: r for r in A.latest_per_key(actions_df(spark), "email_id", "created_at",
                                                      ["actor_email"], tie=("event_id",)).collect()}
    assert latest["e1"].actor_email == "b@x" and latest["e2"].actor_email == "d@x"
    first = {r.email_id: r for r in A.first_action(actions_df(spark), tie="event_id").collect()}
    assert first["e1"].first_actor == "a@x" and first["e1"].n_actions == 2
    assert first["e2"].first_action_at == ts(5) and first["e2"].first_actor == "c@x"


def test_turnaround_counts_unactioned_items(spark):
    queue = spark.createDataFrame(
        [("e1", "PASS", T0), ("e2", "PASS", T0), ("e9", "PASS", T0), (None, "FAIL", T0)],
        "email_id string, validation_status string, queued_at timestamp_ntz")
    r = {x.validation_status: x for x in A.turnaround(queue, actions_df(spark), tie="event_id").collect()}
    assert (r["PASS"].n_items, r["PASS"].n_actioned, r["PASS"].n_actions) == (3, 2, 4)
    assert (r["PASS"].min_seconds, r["PASS"].max_seconds, r["PASS"].avg_seconds) == (300.0, 600.0, 450.0)
    assert (r["FAIL"].n_items, r["FAIL"].n_actioned) == (1, 0)


def test_new_since(spark):
    got = {r.action: r.n_new for r in A.new_since(
        actions_df(spark), "created_at", F.lit(ts(5)).cast("timestamp_ntz"), ["action"]).collect()}
    assert got == {"confirmed": 2, "followup_sent": 1}


def test_followup_from_error_array(spark):
    df = spark.createDataFrame(
        [("e1", "s@x", "ann lee", None, "sap1", [None, "Name too short", None, "Phone is empty", None])],
        "email_id string, sender string, contact_name string, normalized_sap_id string, "
        "sap_id string, errors array<string>")
    row = D.followup_from_errors(df).collect()[0]
    assert row.to_email == "s@x" and row.subject == D.DEFAULT_TEMPLATE.subject
    assert "  - Name too short\n  - Phone is empty\n" in row.body
    assert row.body.startswith("Hello ann,") and "account sap1." in row.body


def test_exact_median_on_many_values(spark):
    import statistics

    vals = {"a": [float((i * 7919) % 10007) for i in range(3001)], "b": [1.0, 2.0, 3.0, 4.0], None: [5.0] * 9 + [1e9],
            "c": [7.5]}
    rows = [(g, v) for g, own in vals.items() for v in own] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in A.exact_median(df, ["g"], "v", "m").collect()}
    assert got == {g: statistics.median_low(own) for g, own in vals.items()}


def test_latest_followup_is_total(spark):
    rows = [("e1", "t@x", "s1", "b1", ts(1)), ("e1", "t@x", "s2", "b0", ts(1)), ("e1", "t@x", "s9", "b9", ts(0))]
    df = spark.createDataFrame(rows, "email_id string, to_email string, subject string, body string, "
                                     "created_at timestamp_ntz")
    for order in (df, df.orderBy(F.desc("subject")), df.repartition(3)):
        assert [(r.subject, r.body) for r in A.latest_followup(order).collect()] == [("s2", "b0")]
