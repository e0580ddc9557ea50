"""Intake and review as runs with one commit each.

The queue is a snapshot: readers keep the old one until the new one is
committed, and can read it as of any earlier commit. A review run's approved
changes, outgoing messages and audit rows become visible together; of two runs
that decide the same message the later one starts over on what is still pending.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import decisions as D
from ..operators import routing as G
from ..sources import tables
from ..sources.runs import Run, RunStore, attempt
from . import intake, joins


def run_intake(store: RunStore, emails: DataFrame, directory: DataFrame, as_of: Column,
               extractor: Callable[[pd.Series], pd.DataFrame] | None = None) -> dict[str, int]:
    """Rebuild the review queue as a new snapshot: row counts per status and the
    ``commit`` that shows it."""
    counts: dict[str, int] = {}

    def work(run: Run) -> int:
        run.write("review_queue", intake.queue_rows(emails, directory, as_of, extractor))
        status = F.col("validation_status")
        counts.update(run.own("review_queue").agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(status == v).alias(v) for v in (G.PASS, G.NEEDS_REVIEW, G.FAIL)]).first().asDict())
        return run.commit()

    number = attempt(store, "intake", work)
    return counts | {"commit": number}


def decides_again(run: Run, upto: int) -> bool:
    """Whether the commits after the run's start hold an action on a message that
    the run acts on."""
    others = run.store.read("review_actions", upto, after=run.seen)
    mine = run.own("review_actions").select("email_id")
    return not joins.semi_join(mine, others, "email_id", "email_id").isEmpty()


def run_review(store: RunStore, emails: DataFrame, actor: str, as_of: Column,
               template: D.FollowupTemplate = D.DEFAULT_TEMPLATE, chosen: DataFrame | None = None) -> dict[str, int]:
    """Decide the pending messages of the committed queue (all, or those in
    ``chosen``): numbers of decisions, and the ``commit`` that shows approved
    changes, outgoing messages and audit rows at once. ``{}`` where nothing is
    pending."""
    counts: dict[str, int] = {}

    def work(run: Run) -> int | None:
        counts.clear()
        dec, path = tables.materialize_at(
            intake.decisions(run.read("review_queue"), run.read("review_actions"), chosen), "decisions")
        try:
            found = {r["decision"]: r["count"] for r in dec.groupBy("decision").count().collect()}
            if not found:
                return None
            run.write("approved_changes", intake.approved(dec, emails, actor, as_of))
            run.write("outgoing_emails", D.outgoing_rows(dec, actor, as_of, template))
            run.write("review_actions", D.audit_rows(dec, actor, as_of, template))
            number = run.commit(decides_again)
        finally:
            tables.remove(store.spark, path)
        counts.update(found)
        return number

    number = attempt(store, "review", work)
    return counts | ({"commit": number} if number else {})


def run_auto_approval(store: RunStore, emails: DataFrame, actor: str, as_of: Column) -> dict[str, int]:
    """R1 as one commit: approve the pending records that passed the pipeline
    outright; ``{}`` where there are none."""
    counts: dict[str, int] = {}

    def work(run: Run) -> int | None:
        rows = D.auto_approvable(intake.decisions(run.read("review_queue"), run.read("review_actions")))
        dec, path = tables.materialize_at(rows, "auto-approvals")
        try:
            counts["approved"] = dec.count()
            if not counts["approved"]:
                return None
            run.write("auto_approved", intake.approved(dec, emails, actor, as_of))
            run.write("review_actions", D.auto_actions(dec, actor, as_of))
            return run.commit(decides_again)
        finally:
            tables.remove(store.spark, path)

    number = attempt(store, "auto_approval", work)
    return counts | {"commit": number} if number else {}
