"""End-to-end jobs: intake (extract -> validate -> look up -> route -> queue)
and review (pending -> decide -> append outputs).

Each stage is a DataFrame -> DataFrame function with a fixed output shape;
nothing runs until a write or an action.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import decisions as D
from ..operators import directory as Dir
from ..operators import extract as X
from ..operators import queue as Q
from ..operators import routing as G
from ..operators import validate as V
from ..sources import schemas, tables
from ..plans import joins


def validated_with_lookup(fields: DataFrame, directory: DataFrame) -> DataFrame:
    """Validate the four fields, then flag directory hits."""
    return Dir.with_directory_flag(V.validate_fields(fields), directory)


def routed(fields: DataFrame, directory: DataFrame) -> DataFrame:
    return G.route(validated_with_lookup(fields, directory))


def first_n(emails: DataFrame, n: int | None) -> DataFrame:
    """An ordered sample of ``n`` messages (by id); ``None`` keeps all."""
    return emails if n is None else emails.orderBy("email_id").limit(n)


def extracted(emails: DataFrame,
              extractor: Callable[[pd.Series], pd.DataFrame] | None = None,
              sample: int | None = None) -> DataFrame:
    """Extraction stage: labelled-text rules, or a user batch extractor."""
    emails = first_n(emails, sample)
    if extractor is None:
        return X.extracted_view(emails)
    dealt = emails.select("email_id", "sender", "body").repartition(X.call_tasks(emails.sparkSession))
    out = X.extract_with(dealt, extractor)
    return out.withColumnRenamed("body", "email_body")


def queue_rows(emails: DataFrame, directory: DataFrame, as_of: Column,
               extractor: Callable[[pd.Series], pd.DataFrame] | None = None) -> DataFrame:
    """The review queue (18 columns) from raw e-mails."""
    return G.review_queue(routed(extracted(emails, extractor), directory), as_of)


def run_intake(emails: DataFrame, directory: DataFrame, queue_path: str, as_of: Column,
               extractor: Callable[[pd.Series], pd.DataFrame] | None = None,
               materialize_extraction: bool = False,
               partition_by: tuple[str, ...] = ("queue_type",)) -> dict[str, int]:
    """Write the queue snapshot to ``queue_path`` and return row counts per
    status, gathered while writing (no second pass over the data). The
    snapshot is partitioned by queue so per-queue reads prune folders; read it
    back with ``tables.read_queue``.

    With ``materialize_extraction`` the extraction output is first written
    under ``spark.checkpoint.dir`` so later stages (and task retries) never
    call the extractor again.
    """
    ext, written = extracted(emails, extractor), None
    if materialize_extraction:
        ext, written = tables.materialize_at(ext, "extracted")
    q = G.review_queue(routed(ext, directory), as_of)
    obs = Observation("intake")
    status = F.col("validation_status")
    q = q.observe(obs, F.count(F.lit(1)).alias("rows"),
                  F.count_if(status == G.PASS).alias(G.PASS),
                  F.count_if(status == G.NEEDS_REVIEW).alias(G.NEEDS_REVIEW),
                  F.count_if(status == G.FAIL).alias(G.FAIL))
    tables.write_snapshot(q, queue_path, schemas.REVIEW_QUEUE, list(partition_by) or None)
    if written:
        tables.remove(q.sparkSession, written)
    return dict(obs.get)


def run_directory_refresh(ids: DataFrame, path: str, as_of: Column,
                          id_col: str = "sap_id") -> int:
    """Rebuild the directory snapshot at ``path`` with its fixed schema
    from raw ids (distinct, upper-cased, NULLs dropped); returns its size."""
    directory = Dir.build_directory(ids, id_col, as_of)
    obs = Observation("directory")
    directory = directory.observe(obs, F.count(F.lit(1)).alias("rows"))
    tables.write_snapshot(directory, path, schemas.DIRECTORY)
    return obs.get["rows"]


# Of several queue rows with one id, the one decided on: the latest queued,
# then the largest by the other columns.
ROW_ORDER = ("queued_at",)


def decisions(queue: DataFrame, actions: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """One decision per pending id (rows without an id are left out). ``chosen``
    (``email_id`` and, where given, ``actor``, ``subject``, ``body``) limits them
    to the items a reviewer picked, under that reviewer's name and wording.
    No message bodies are read."""
    pend = joins.one_row_per_key(Q.pending(queue, actions), "email_id", ROW_ORDER)
    return D.decide(D.with_choices(pend, chosen))


def approved(dec: DataFrame, emails: DataFrame, actor: str, as_of: Column) -> DataFrame:
    """Approved changes, with the message bodies of the confirmed ids alone."""
    return D.approved_rows(Q.with_body(dec.where(F.col("decision") == D.CONFIRM), emails), actor, as_of)


def without_id(queue: DataFrame, actions: DataFrame) -> DataFrame:
    """Pending rows that can't be decided because they have no id (a report)."""
    return Q.pending(queue, actions).where(F.col("email_id").isNull())


def run_review(queue: DataFrame, emails: DataFrame, actor: str, as_of: Column,
               approved_table: str = "approved_changes",
               outgoing_table: str = "outgoing_emails",
               actions_table: str = "review_actions",
               template: D.FollowupTemplate = D.DEFAULT_TEMPLATE,
               chosen: DataFrame | None = None) -> dict[str, int]:
    """Decide pending items -- all, or those in ``chosen`` -- and append the results.

    Pending means: no audit row yet; one decision is made per id, and rows
    without an id are counted as ``no_id`` and stay out of the outputs. The
    decisions are written once under the checkpoint folder (and removed at the
    end); every output is a projection of that table. Each append only adds
    rows whose id is not yet in its target table, and the audit rows go last,
    so a re-run -- also one after a failure between the appends -- completes
    what is missing and duplicates nothing.
    """
    spark = queue.sparkSession
    done = spark.table(actions_table)
    no_id = without_id(queue, done).count()
    dec, path = tables.materialize_at(decisions(queue, done, chosen), "decisions")
    outputs = ((approved_table, approved(dec, emails, actor, as_of), schemas.APPROVED_CHANGES),
               (outgoing_table, D.outgoing_rows(dec, actor, as_of, template),
                schemas.OUTGOING_EMAILS),
               (actions_table, D.audit_rows(dec, actor, as_of, template), schemas.REVIEW_ACTIONS))
    for table, rows, schema in outputs:
        fresh = joins.anti_join(rows, spark.table(table), "email_id", "email_id")
        tables.append(fresh, table, schema)
    counts = {r["decision"]: r["count"] for r in dec.groupBy("decision").count().collect()}
    tables.remove(spark, path)
    return counts | ({"no_id": no_id} if no_id else {})


def run_auto_approval(queue: DataFrame, emails: DataFrame, actor: str, as_of: Column,
                      auto_table: str = "auto_approved",
                      actions_table: str = "review_actions") -> int:
    """Approve, without a reviewer, the pending records that passed the
    pipeline outright; their rows go to ``auto_approved`` and, marked as
    automatic, to the audit log. Returns the number of approvals; a re-run adds
    nothing."""
    spark = queue.sparkSession
    dec, path = tables.materialize_at(
        D.auto_approvable(decisions(queue, spark.table(actions_table))), "auto-approvals")
    rows = approved(dec, emails, actor, as_of)
    audit = D.auto_actions(dec, actor, as_of)
    for table, out, schema in ((auto_table, rows, schemas.APPROVED_CHANGES),
                               (actions_table, audit, schemas.REVIEW_ACTIONS)):
        tables.append(joins.anti_join(out, spark.table(table), "email_id", "email_id"), table, schema)
    n = dec.count()
    tables.remove(spark, path)
    return n
