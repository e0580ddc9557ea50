"""Named queries over the driver's tables, one per inventory item.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables.
Array results are also given as text (``|``-joined, NULL slot = empty) so
engines can compare them; timestamps are the fixed run stamp or data times.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqlfuncs import register_functions
from ..operators import audit as A
from ..operators import decisions as D
from ..operators import directory as Dir
from ..operators import extract as X
from ..operators import queue as Q
from ..operators import routing as G
from ..operators import validate as V
from ..sources import fixtures as fx
from ..sources import runs, tables
from ..streaming.intake_stream import start_intake_stream
from . import composed_sql, extraction_store, intake, log_state, review_runs, search_index

ACTOR = "reviewer@example.com"
SEARCH_TEXT = "SAP0012"
SEARCH_PATTERN = "SAP00_2%1"
SINCE = "2024-01-15 00:00:00"
TOPK = 100

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def as_of() -> Column:
    return F.expr(fx.as_of_sql())


def errors_text(c: str) -> Column:
    """Array as text: ``|``-joined, a NULL element as an empty slot."""
    return F.array_join(F.col(c), "|", "")


# -- shared stages -----------------------------------------------------------

def directory(spark: SparkSession, d: str) -> DataFrame:
    return Dir.build_directory(fx.directory_ids(spark, d), as_of=as_of())


def routed_direct(spark: SparkSession, d: str) -> DataFrame:
    return intake.routed(fx.fields(spark, d), directory(spark, d))


def queue_direct(spark: SparkSession, d: str) -> DataFrame:
    return G.review_queue(routed_direct(spark, d), as_of())


def queue_extracted(spark: SparkSession, d: str) -> DataFrame:
    """The intake's queue of the fixture e-mails (lazy; one consumer)."""
    return intake.queue_rows(fx.emails(spark, d), directory(spark, d), as_of())


def pending_extracted(spark: SparkSession, d: str) -> DataFrame:
    return Q.pending(queue_extracted(spark, d), fx.actions(spark, d))


def decided(spark: SparkSession, d: str) -> DataFrame:
    """Decisions on every pending id, without message bodies."""
    return intake.decisions(queue_extracted(spark, d), fx.actions(spark, d))


def decided_once(spark: SparkSession, d: str) -> DataFrame:
    """Decisions that two parts of one plan read: written under the checkpoint folder."""
    return tables.materialize(decided(spark, d), "decisions")


def corrected_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decisions on the pending records after the reviewers' corrections."""
    merged = D.merge_corrections(pending_extracted(spark, d), fx.corrections(spark, d))
    return tables.materialize(D.decide(merged.drop("changed_fields")), "corrected-decisions")


def field_reader(bodies: pd.Series) -> pd.DataFrame:
    """A stand-in for a model client: finds values by their shape, answers in
    reverse order under its input's index, reports its own errors, and fails as
    a whole on a body that it can't read."""
    if bodies.str.contains("Cher", regex=False).any():
        raise ValueError("unreadable body")
    late = bodies.str.contains("no form attached", regex=False)
    shapes = {"sap_id": r"(SAP[0-9]{6})", "contact_email": r"(user[0-9]+@example\.org)",
              "contact_phone": r"([0-9]{3}\.555\.[0-9]{4})"}
    out = pd.DataFrame({f: bodies.str.extract(p)[0].where(~late) for f, p in shapes.items()}, index=bodies.index)
    out["extraction_error"] = late.map({True: "model timeout", False: None})
    return out.iloc[::-1]


# -- extraction ---------------------------------------------------------------

@query
def emails_extracted(spark, d):
    return X.extracted_view(fx.emails(spark, d)).drop("email_body")


@query
def extraction_outcome(spark, d):
    return X.extraction_outcome(X.extracted_view(fx.emails(spark, d)))


@query
def variant_response_fields(spark, d):
    return X.parse_responses(fx.responses(spark, d)).select(
        "email_id", *X.EXTRACTION_FIELDS, "extraction_error")


@query
def extractor_fields(spark, d):
    emails = fx.emails(spark, d).select("email_id", "sender", "body").repartition(X.call_tasks(spark))
    return X.extract_with(emails, field_reader).select(
        "email_id", *X.EXTRACTION_FIELDS, "extraction_error")


@query
def variant_column_fields(spark, d):
    rows = fx.responses(spark, d).withColumn("response", F.try_parse_json("response"))
    return X.parse_responses(rows).select("email_id", *X.EXTRACTION_FIELDS, "extraction_error")


# -- field rules --------------------------------------------------------------

def _single(df: DataFrame, column: str, normalized: bool) -> DataFrame:
    cols = [F.col("email_id"), F.col(column).alias("value"),
            F.col("validation.is_valid").alias("is_valid")]
    if normalized:
        cols.append(F.col("validation.normalized").alias("normalized"))
    return df.select(*cols, F.col("validation.error").alias("error"))


@query
def validate_email(spark, d):
    return _single(V.validate_email(fx.fields(spark, d), "contact_email"), "contact_email", False)


@query
def validate_phone(spark, d):
    return _single(V.validate_phone(fx.fields(spark, d), "contact_phone"), "contact_phone", True)


@query
def validate_account_id(spark, d):
    return _single(V.validate_account_id(fx.fields(spark, d), "sap_id"), "sap_id", True)


@query
def validate_name(spark, d):
    return _single(V.validate_name(fx.fields(spark, d), "contact_name"), "contact_name", True)


@query
def validation_shaped(spark, d):
    return V.validate_fields(fx.fields(spark, d)).select(
        "email_id", "sap_id_valid", "name_valid", "email_valid", "phone_valid",
        "normalized_sap_id", "normalized_name", "normalized_phone",
        errors_text("error_list").alias("error_list"))


@query
def issue_list_long(spark, d):
    return V.issues_long(V.with_issues(fx.fields(spark, d), V.DEFAULT_FIELDS))


@query
def issue_summary(spark, d):
    return (issue_list_long(spark, d).groupBy("field", "code")
            .agg(F.count(F.lit(1)).alias("n_issues")))


# -- directory ----------------------------------------------------------------

@query
def directory_distinct(spark, d):
    return Dir.build_directory(fx.emails(spark, d).select("sap_id"), as_of=as_of())


@query
def directory_exists_join(spark, d):
    return intake.validated_with_lookup(fx.fields(spark, d), directory(spark, d)).select(
        "email_id", "normalized_sap_id", "sap_exists")


@query
def directory_exists_filtered(spark, d):
    """The lookup of checked records that were written once, sure misses unshuffled."""
    checked = tables.materialize(V.validate_fields(fx.fields(spark, d)).select("email_id", "normalized_sap_id"), "checked")
    return Dir.with_directory_flag(checked, directory(spark, d), filtered=True)


@query
def directory_exists_sqlfunc(spark, d):
    directory(spark, d).createOrReplaceTempView("_q_directory")
    fx.fields(spark, d).createOrReplaceTempView("_q_fields")
    register_functions(spark, "_q_directory")
    return spark.sql("""
        SELECT email_id, normalized_sap_id, fn_sap_exists(normalized_sap_id) AS sap_exists
        FROM (SELECT email_id, fn_validate_sap_id(sap_id).normalized AS normalized_sap_id
              FROM _q_fields)""")


@query
def null_flag_routing(spark, d):
    rows = routed_direct(spark, d)
    gone = {f: F.when(F.expr(f"c_custkey % 5 = {i}"), F.lit(None)).otherwise(F.col(f))
            for i, f in enumerate((*G.FLAGS, "sap_exists"))}
    return G.route(rows.drop("validation_status", "queue_type").withColumns(gone)).select(
        "email_id", *G.FLAGS, "sap_exists", "validation_status", "queue_type")


# -- routing and queue --------------------------------------------------------

@query
def routed(spark, d):
    return routed_direct(spark, d).select(
        "email_id", *G.FLAGS, "sap_exists", "validation_status", "queue_type")


@query
def routing_summary(spark, d):
    return G.routing_summary(routed_direct(spark, d))


@query
def review_queue(spark, d):
    return queue_direct(spark, d).withColumn("errors", errors_text("errors"))


@query
def review_record_packed(spark, d):
    return G.review_record(queue_direct(spark, d)).select("review_record.*")


@query
def review_errors_positional(spark, d):
    return queue_direct(spark, d).select(
        "email_id", errors_text("errors").alias("errors"), F.size("errors").cast("long").alias("n_slots"))


@query
def review_errors_compact(spark, d):
    return G.compact_errors(queue_direct(spark, d)).select(
        "email_id", errors_text("errors_compact").alias("errors_compact"),
        F.size("errors_compact").cast("long").alias("n_errors"))


@query
def review_record_sql(spark, d):
    return composed_sql.review_records(spark, fx.emails(spark, d), directory(spark, d))


@query
def needs_review_view(spark, d):
    return Q.needs_review_view(queue_direct(spark, d)).withColumn("errors", errors_text("errors"))


@query
def auto_approve_view(spark, d):
    return Q.auto_approve_view(queue_direct(spark, d))


# -- review side ----------------------------------------------------------------

@query
def pending_items(spark, d):
    return Q.pending_items(queue_extracted(spark, d), fx.actions(spark, d))


@query
def pending_search(spark, d):
    return Q.pending_items(queue_extracted(spark, d), fx.actions(spark, d), search=SEARCH_TEXT)


@query
def pending_topk(spark, d):
    return Q.pending_items(queue_extracted(spark, d), fx.actions(spark, d), limit=TOPK)


@query
def kpi_counts(spark, d):
    return Q.kpi_counts(pending_extracted(spark, d))


@query
def pending_with_body(spark, d):
    return Q.with_body(pending_extracted(spark, d), fx.emails(spark, d)).select(
        "email_id", "validation_status", "email_body")


@query
def status_labels(spark, d):
    return Q.status_labels(pending_extracted(spark, d)).select(
        "email_id", "validation_status", "status_display", "badge_title", "badge_detail")


@query
def decisions(spark, d):
    return decided(spark, d).select(
        "email_id", "decision", "all_valid", "sap_value", "name_value", "email_value",
        "phone_value", F.size("issues").cast("long").alias("n_issues"))


@query
def approved_changes(spark, d):
    return intake.approved(decided_once(spark, d), fx.emails(spark, d), ACTOR, as_of())


@query
def confirm_actions(spark, d):
    return D.confirm_actions(decided(spark, d), ACTOR, as_of())


@query
def outgoing_emails(spark, d):
    return D.outgoing_rows(decided(spark, d), ACTOR, as_of())


@query
def followup_actions(spark, d):
    return D.followup_actions(decided(spark, d), ACTOR, as_of())


@query
def batch_approve(spark, d):
    dec = D.auto_approvable(decided_once(spark, d))
    return intake.approved(dec, fx.emails(spark, d), ACTOR, as_of())


@query
def chosen_decisions(spark, d):
    dec = intake.decisions(queue_extracted(spark, d), fx.actions(spark, d), fx.choices(spark, d))
    return dec.select("email_id", "decision", F.coalesce("chosen_actor", F.lit(ACTOR)).alias("actor"))


@query
def edited_followups(spark, d):
    dec = intake.decisions(queue_extracted(spark, d), fx.actions(spark, d), fx.choices(spark, d))
    return D.outgoing_rows(dec, ACTOR, as_of())


@query
def corrected_approvals(spark, d):
    return intake.approved(corrected_decisions(spark, d), fx.emails(spark, d), ACTOR, as_of())


@query
def auto_approved(spark, d):
    dec = D.auto_approvable(corrected_decisions(spark, d))
    return intake.approved(dec, fx.emails(spark, d), ACTOR, as_of())


@query
def auto_approved_actions(spark, d):
    return D.auto_actions(corrected_decisions(spark, d), ACTOR, as_of())


@query
def merge_corrections(spark, d):
    merged = D.merge_corrections(pending_extracted(spark, d), fx.corrections(spark, d))
    return merged.select("email_id", *D.CORRECTABLE,
                         F.array_join("changed_fields", "|").alias("changed_fields"))


@query
def followup_from_errors(spark, d):
    q = queue_direct(spark, d).where(F.col("validation_status") != G.PASS)
    return D.followup_from_errors(q)


# -- audit ----------------------------------------------------------------------

@query
def audit_log_topk(spark, d):
    return A.audit_log(fx.actions(spark, d), limit=TOPK, tie=("event_id",))


@query
def followup_list(spark, d):
    return A.followup_list(D.outgoing_rows(decided(spark, d), ACTOR, as_of()), limit=TOPK)


@query
def latest_followup(spark, d):
    acts = fx.actions(spark, d).where(F.col("action") == D.ACTION_FOLLOWUP)
    return A.latest_per_key(acts, "email_id", "created_at", ["actor_email"], tie=("event_id",))


@query
def latest_followup_text(spark, d):
    return A.latest_followup(fx.outgoing(spark, d)).select("email_id", "created_at", "subject", "body")


@query
def followup_list_timed(spark, d):
    return A.followup_list(fx.outgoing(spark, d), limit=TOPK, tie=("email_id", "subject", "created_by"))


@query
def turnaround(spark, d):
    return A.turnaround(queue_extracted(spark, d), fx.actions(spark, d), tie="event_id")


@query
def turnaround_by_actor(spark, d):
    return A.turnaround(queue_extracted(spark, d), fx.actions(spark, d), tie="event_id",
                        by=("validation_status", "first_actor"))


@query
def turnaround_quantiles(spark, d):
    return A.turnaround(queue_extracted(spark, d), fx.actions(spark, d), tie="event_id",
                        quantiles=A.TAIL_QUANTILES)


@query
def new_since(spark, d):
    return A.new_since(fx.actions(spark, d), "created_at",
                       F.expr(f"TIMESTAMP_NTZ '{SINCE}'"), ["action"])


# -- jobs that write, read back ---------------------------------------------------

def sink_folder(spark: SparkSession, name: str) -> str:
    return f"{tables.materialized_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def run_store(spark: SparkSession, name: str, known: dict[str, runs.RunTable] | None = None) -> runs.RunStore:
    return runs.RunStore(spark, sink_folder(spark, name), known)


def reviewed_table(spark: SparkSession, d: str, table: str) -> DataFrame:
    """One of the review's output tables after two runs over an empty log (the
    second adds nothing)."""
    store = run_store(spark, "review")
    review_runs.run_intake(store, fx.emails(spark, d), directory(spark, d), as_of())
    for _ in range(2):
        review_runs.run_review(store, fx.emails(spark, d), ACTOR, as_of())
    return store.read(table)


@query
def queue_as_of_run(spark, d):
    """The queue of the first of two intake runs; the second had no directory."""
    store = run_store(spark, "queue-runs")
    emails = fx.emails(spark, d)
    first = review_runs.run_intake(store, emails, directory(spark, d), as_of())["commit"]
    review_runs.run_intake(store, emails, directory(spark, d).where("false"), as_of())
    return store.read("review_queue", upto=first).withColumn("errors", errors_text("errors"))


@query
def extraction_reused(spark, d):
    """Fields from the result store after two runs: the second only tries the
    bodies again that the extractor failed on."""
    store = run_store(spark, "extractions", {extraction_store.RESULTS: extraction_store.RESULT_TABLE})
    emails = fx.emails(spark, d).select("email_id", "sender", "body")
    for _ in range(2):
        extraction_store.run_extraction(store, emails, field_reader)
    return extraction_store.with_results(store, emails).select(
        "email_id", *X.EXTRACTION_FIELDS, "extraction_error", "attempts")


def indexed_store(spark: SparkSession, d: str) -> runs.RunStore:
    store = run_store(spark, "search", search_index.TABLES)
    review_runs.run_intake(store, fx.emails(spark, d), directory(spark, d), as_of())
    search_index.build_index(store)
    return store


@query
def pending_search_indexed(spark, d):
    return search_index.pending_search(indexed_store(spark, d), fx.actions(spark, d), SEARCH_TEXT)


@query
def pending_like_indexed(spark, d):
    return search_index.pending_search(indexed_store(spark, d), fx.actions(spark, d), SEARCH_PATTERN, mode="like")


LOG_PIECES = 3


def piecewise_log(spark: SparkSession, d: str, after_each) -> runs.RunStore:
    """The action log committed in ``LOG_PIECES`` runs whose times interleave;
    ``after_each`` is called after every one."""
    store = run_store(spark, "log", log_state.TABLES)
    actions = fx.actions(spark, d).withColumns({"old_values": F.lit(None).cast("string"),
                                                "new_values": F.lit(None).cast("string")})
    for piece in range(LOG_PIECES):
        run = store.begin("log")
        run.write(log_state.LOG, actions.where(F.col("event_id") % LOG_PIECES == piece))
        run.commit()
        after_each(store)
    return store


@query
def action_state(spark, d):
    store = piecewise_log(spark, d, log_state.update_state)
    return log_state.flat_state(store.read(log_state.STATE))


@query
def pending_by_state(spark, d):
    """The pending list against the state's ids, not the log."""
    store = piecewise_log(spark, d, log_state.update_state)
    return Q.pending_items(queue_extracted(spark, d), store.read(log_state.STATE))


@query
def alerts_since_mark(spark, d):
    store = piecewise_log(spark, d, log_state.alert)
    return store.read(log_state.ALERTS).select("action", "n_new", "latest_at", "from_commit", "to_commit")


@query
def sink_directory(spark, d):
    path = sink_folder(spark, "directory")
    intake.run_directory_refresh(fx.emails(spark, d).select("sap_id"), path, as_of())
    return spark.read.parquet(path)


@query
def sink_review_queue(spark, d):
    path = sink_folder(spark, "queue")
    intake.run_intake(fx.emails(spark, d), directory(spark, d), path, as_of())
    return tables.read_queue(spark, path).withColumn("errors", errors_text("errors"))


@query
def sink_catalog_queue(spark, d):
    name = f"queue_{uuid.uuid4().hex[:12]}"
    tables.save_table(queue_extracted(spark, d), name, sink_folder(spark, name))
    return spark.table(name).withColumn("errors", errors_text("errors"))


@query
def intake_counts(spark, d):
    counts = intake.run_intake(fx.emails(spark, d), directory(spark, d), sink_folder(spark, "queue"), as_of())
    return spark.createDataFrame(sorted(counts.items()), "measure string, n long")


@query
def sink_approved_changes(spark, d):
    return reviewed_table(spark, d, "approved_changes")


@query
def sink_outgoing_emails(spark, d):
    return reviewed_table(spark, d, "outgoing_emails")


@query
def sink_review_actions(spark, d):
    return reviewed_table(spark, d, "review_actions").drop("action_date")


@query
def sink_audit_csv(spark, d):
    path = sink_folder(spark, "audit-csv")
    A.export_audit_log(fx.actions(spark, d), path, tie=("event_id",))
    return spark.read.options(header=True, **tables.CSV_STAMPS).schema(
        "email_id string, action string, actor_email string, created_at timestamp_ntz, reason string").csv(path)


@query
def stream_queue(spark, d):
    source, out = sink_folder(spark, "incoming"), sink_folder(spark, "stream-queue")
    fx.emails(spark, d).select("email_id", "sender", "body", "sap_id").repartition(3, "email_id").write.parquet(source)
    start_intake_stream(spark, source, directory(spark, d), out, sink_folder(spark, "stream-state"),
                        as_of=as_of(), max_files_per_trigger=1).awaitTermination()
    return tables.read_queue(spark, out).withColumn("errors", errors_text("errors"))


@query
def stream_resent(spark, d):
    """Every message comes twice, in later files; the queue has it once."""
    source, out = sink_folder(spark, "incoming"), sink_folder(spark, "stream-queue")
    emails = fx.emails(spark, d).select("email_id", "sender", "body", "sap_id")
    emails.repartition(2, "email_id").write.parquet(source)
    emails.repartition(2, "sender").write.mode("append").parquet(source)
    start_intake_stream(spark, source, directory(spark, d), out, sink_folder(spark, "stream-state"),
                        as_of=as_of(), max_files_per_trigger=1, resent_within="1 day").awaitTermination()
    return tables.read_queue(spark, out).withColumn("errors", errors_text("errors"))


# -- documents ------------------------------------------------------------------

@query
def document_contacts(spark, d):
    return X.document_addresses(fx.documents(spark, d))
