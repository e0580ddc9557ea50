"""The streaming intake gives the batch intake's rows."""
import os

from pyspark.sql import functions as F

from conftest import SF001
from contactlane.plans import queries as QS
from contactlane.sources import fixtures as fx
from contactlane.sources import tables
from contactlane.streaming.intake_stream import start_intake_stream, stream_counts


def test_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "incoming")
    emails = fx.emails(spark, SF001).select("email_id", "sender", "body", "sap_id")
    emails.repartition(3).write.parquet(src)
    out = os.path.join(tmpdir_path, "queue")
    q = start_intake_stream(spark, src, QS.directory(spark, SF001), out,
                            os.path.join(tmpdir_path, "ckpt"), as_of=QS.as_of(),
                            max_files_per_trigger=1)
    q.awaitTermination(300)
    streamed = tables.read_queue(spark, out)
    batch = QS.queue_extracted(spark, SF001)
    cols = [c for c in batch.columns if c != "errors"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b and len(a) == 150
    assert spark.read.parquet(out).select(F.countDistinct("batch_id")).first()[0] >= 2


def _send(spark, folder, rows, with_time=False):
    schema = "email_id string, sender string, body string, sap_id string" + (", sent_at timestamp" if with_time else "")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def _run(spark, base, **more):
    q = start_intake_stream(spark, f"{base}/in", QS.directory(spark, SF001), f"{base}/out", f"{base}/state",
                            as_of=QS.as_of(), max_files_per_trigger=1, **more)
    q.awaitTermination()
    queue = tables.read_queue(spark, f"{base}/out")
    return stream_counts(q), sorted(((r["email_id"], r["sender"]) for r in queue.collect()), key=str)


def test_resent_messages_give_one_row(spark, tmpdir_path):
    body = "Name: A B SAP ID: SAP000001"
    _send(spark, f"{tmpdir_path}/in", [("e1", "first@x", body, None), ("e2", "a@x", body, None), (None, "n1@x", body, None)])
    counts, rows = _run(spark, tmpdir_path, resent_within="1 hour")
    assert rows == [("e1", "first@x"), ("e2", "a@x"), (None, "n1@x")] and counts["resent"] == 0
    # in later micro-batches of a restarted query, and twice in one
    _send(spark, f"{tmpdir_path}/in", [("e1", "later@x", None, None), ("e3", "b@x", body, None), ("e3", "b@x", body, None)])
    _send(spark, f"{tmpdir_path}/in", [("e3", "c@x", body, None), (None, "n1@x", body, None), (None, "n1@x", body, None)])
    counts, rows = _run(spark, tmpdir_path, resent_within="1 hour")
    assert rows == sorted([("e1", "first@x"), ("e2", "a@x"), ("e3", "b@x")] + [(None, "n1@x")] * 3, key=str)
    assert counts == {"rows": 6, "resent": 3, "late": 0}
    assert _run(spark, tmpdir_path, resent_within="1 hour")[1] == rows   # nothing new


def test_late_and_expired_messages_by_event_time(spark, tmpdir_path):
    import datetime as dt

    def at(hour, minute=0):
        return dt.datetime(2024, 1, 5, hour, minute)

    def go():
        return _run(spark, tmpdir_path, resent_within="1 hour", event_time="sent_at")
    _send(spark, f"{tmpdir_path}/in", [("e1", "a@x", "", None, at(8))], True)
    go()
    _send(spark, f"{tmpdir_path}/in", [("e1", "b@x", "", None, at(8, 30)), ("e2", "a@x", "", None, at(12))], True)
    counts, rows = go()
    assert counts["resent"] == 1 and rows == [("e1", "a@x"), ("e2", "a@x")]
    # the watermark is at 11: e3 is late; e1's state has expired, so it is a new message
    _send(spark, f"{tmpdir_path}/in", [("e3", "a@x", "", None, at(9)), ("e1", "c@x", "", None, at(12, 30))], True)
    counts, rows = go()
    assert counts == {"rows": 2, "resent": 0, "late": 1}
    assert rows == [("e1", "a@x"), ("e1", "c@x"), ("e2", "a@x")]
