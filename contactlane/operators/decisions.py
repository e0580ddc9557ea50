"""Review decisions as bulk jobs.

Every pending record is decided at once: its preferred values are validated
again with the reviewer rules; complete records with a known account are
confirmed, the rest get a follow-up message. Confirmations and follow-ups are
projections of one decisions DataFrame, so both outputs come from the same
evaluation and a re-run over the (anti-joined) pending set adds nothing.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textops as tx
from ..functions.rules import REVIEWER_MESSAGES
from ..functions.sqltext import ident
from ..plans.joins import lookup
from . import validate as V
from .extract import LABELS

CONFIRM, FOLLOWUP = "confirm", "followup"
# Audit action names, follow-up reason and outgoing status.
ACTION_CONFIRMED = "confirmed"
ACTION_FOLLOWUP = "followup_sent"
ACTION_AUTO = "auto_approved"
AUTO_REASON = "Passed all checks"
FOLLOWUP_REASON = "Missing or invalid fields"
OUTGOING_STATUS = "pending"


# One example value for each field of the reply form.
REPLY_EXAMPLES = {"sap_id": "SAP004711", "contact_name": "Robin Vale",
                  "contact_email": "robin.vale@mail.example", "contact_phone": "(303) 555-0188"}


def reply_form() -> str:
    """A line per field, labelled as the extraction reads it (the longest label)."""
    def label(field: str) -> str:
        return LABELS[field].replace("(?:", "").replace(")?", "")
    return "\n".join(f"{label(f)} {v}" for f, v in REPLY_EXAMPLES.items())


@dataclass(frozen=True)
class FollowupTemplate:
    """Wording of follow-up messages. ``body`` may use ``{first_name}``,
    ``{account}``, ``{issues}`` and ``{reply_form}``; ``issue_line`` may use ``{field}`` and
    ``{error}``."""

    subject: str = "More details needed for your account update request"
    body: str = (
        "Hello {first_name},\n\n"
        "Thanks for asking us to update the contact details of account {account}.\n"
        "Before we can make the change, please check the following:\n\n"
        "{issues}\n\n"
        "You can reply to this message with the details laid out like this:\n\n"
        "{reply_form}\n\n"
        "We will finish the update as soon as we have them.\n\n"
        "Kind regards,\n"
        "Customer Service")
    issue_line: str = "  - {field}: {error}"
    error_line: str = "  - {error}"
    greeting_fallback: str = "there"
    account_fallback: str = "[your account]"


DEFAULT_TEMPLATE = FollowupTemplate()


def render(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders of ``template`` with Column values."""
    parts: list[Column] = []
    for text, field, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field is not None:
            parts.append(values[field])
    return F.concat(*parts) if parts else F.lit("")


def _present(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def preferred_values(df: DataFrame) -> DataFrame:
    """Normalised value, else raw value, else '' (blank falls through)."""
    return df.withColumns({
        "sap_value": F.coalesce(_present("normalized_sap_id"), _present("sap_id"), F.lit("")),
        "name_value": F.coalesce(_present("normalized_name"), _present("contact_name"), F.lit("")),
        "email_value": F.coalesce(_present("contact_email"), F.lit("")),
        "phone_value": F.coalesce(_present("normalized_phone"), _present("contact_phone"),
                                  F.lit("")),
    })


_VALUE_FIELDS = {"sap_id": "sap_value", "name": "name_value",
                 "email": "email_value", "phone": "phone_value"}


def decide(pending_rows: DataFrame, include_lookup_issue: bool = False) -> DataFrame:
    """``decision`` per pending row plus the values and issues behind it.

    A well-formed account id missing from the directory leads to a follow-up
    with no field issue; with ``include_lookup_issue`` the issue list then
    also names it (code ``sap_id.unknown``).
    """
    out = V.with_issues(preferred_values(pending_rows), _VALUE_FIELDS,
                        normalized={"sap_id": "final_sap_id", "name": "final_name",
                                    "phone": "final_phone"})
    if include_lookup_issue:
        missing = F.struct(F.lit("SAP ID").alias("field"), F.lit("sap_id.unknown").alias("code"),
                           F.lit(REVIEWER_MESSAGES["sap_id.unknown"]).alias("error"))
        unknown = F.col("final_sap_id").isNotNull() & ~F.coalesce(F.col("sap_exists"), F.lit(False))
        out = out.withColumn("issues", F.concat(
            F.col("issues"), F.array_compact(F.array(F.when(unknown, missing)))))
    return out.withColumn(
        "decision",
        F.when(F.col("all_valid") & F.coalesce(F.col("sap_exists"), F.lit(False)),
               F.lit(CONFIRM)).otherwise(F.lit(FOLLOWUP)))


def with_choices(pending_rows: DataFrame, chosen: DataFrame | None) -> DataFrame:
    """``pending_rows`` (one per id) with ``chosen_actor``, ``chosen_subject`` and
    ``chosen_body``. Given ``chosen`` (``email_id`` and any of ``actor``,
    ``subject``, ``body``), only the ids in it stay; of several choices for one
    id the largest counts. Without it all rows stay, with no choices."""
    names = ("actor", "subject", "body")
    if chosen is None:
        return pending_rows.withColumns({f"chosen_{n}": F.lit(None).cast("string") for n in names})
    picked = chosen.where(F.col("email_id").isNotNull()).select(
        F.col("email_id").alias("_ch_id"),
        *[(F.nullif(F.col(n), F.lit("")) if n in chosen.columns else F.lit(None)).cast("string")
          .alias(f"chosen_{n}") for n in names])
    picked = picked.groupBy("_ch_id").agg(F.max(F.struct(*[f"chosen_{n}" for n in names])).alias("_ch"))
    picked = picked.select("_ch_id", "_ch.*", F.lit(True).alias("_ch_hit"))
    return lookup(pending_rows, picked, "email_id", "_ch_id").where("_ch_hit").drop("_ch_hit")


def _chosen(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(f"chosen_{name}"), default) if f"chosen_{name}" in df.columns else default


def approved_rows(decisions: DataFrame, actor: str, as_of: Column,
                  body: str = "email_body") -> DataFrame:
    """One approved change per confirmed record (normalised id, name and
    phone; the e-mail as given). ``decisions`` has the message bodies in ``body``."""
    return (decisions.where(F.col("decision") == CONFIRM)
            .select("email_id", F.col("final_sap_id").alias("sap_id"),
                    F.col("final_name").alias("contact_name"),
                    F.col("email_value").alias("contact_email"),
                    F.col("final_phone").alias("contact_phone"),
                    F.coalesce(F.col(body), F.lit("")).alias("source_email_body"),
                    _chosen(decisions, "actor", F.lit(actor)).alias("approved_by"), as_of.alias("approved_at")))


def confirm_actions(decisions: DataFrame, actor: str, as_of: Column) -> DataFrame:
    """Audit rows ``confirmed`` with the approved values as JSON."""
    new_values = F.to_json(F.struct(F.col("final_sap_id").alias("sap_id"),
                                    F.col("final_name").alias("contact_name"),
                                    F.col("email_value").alias("contact_email"),
                                    F.col("final_phone").alias("contact_phone")),
                           {"ignoreNullFields": "false"})
    return (decisions.where(F.col("decision") == CONFIRM)
            .select("email_id", F.lit(ACTION_CONFIRMED).alias("action"),
                    _chosen(decisions, "actor", F.lit(actor)).alias("actor_email"),
                    F.lit(None).cast("string").alias("old_values"),
                    new_values.alias("new_values"),
                    F.lit(None).cast("string").alias("reason"), as_of.alias("created_at")))


def _greeting_name(template: FollowupTemplate) -> Column:
    first = F.expr(tx.first_word(ident("contact_name")))
    return F.coalesce(first, F.lit(template.greeting_fallback))


def _account_ref(template: FollowupTemplate) -> Column:
    return F.coalesce(_present("normalized_sap_id"), _present("sap_id"),
                      F.lit(template.account_fallback))


def _lines(items: Column, line: str, element: dict[str, str]) -> Column:
    def one(item: Column) -> Column:
        return render(line, {k: item[v] if v else item for k, v in element.items()})
    return F.array_join(F.transform(items, one), "\n")


def followup_message(df: DataFrame, template: FollowupTemplate = DEFAULT_TEMPLATE,
                     issues: str = "issues") -> DataFrame:
    """``subject`` and ``body`` from the issue list (field + error)."""
    lines = _lines(F.col(issues), template.issue_line, {"field": "field", "error": "error"})
    body = render(template.body, {"first_name": _greeting_name(template),
                                  "account": _account_ref(template), "issues": lines,
                                  "reply_form": F.lit(reply_form())})
    return df.withColumns({"subject": F.lit(template.subject), "message_body": body})


def outgoing_rows(decisions: DataFrame, actor: str, as_of: Column,
                  template: FollowupTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """One outgoing message per follow-up, addressed to the sender."""
    return (followup_message(decisions.where(F.col("decision") == FOLLOWUP), template)
            .select("email_id", F.col("sender").alias("to_email"),
                    _chosen(decisions, "subject", F.col("subject")).alias("subject"),
                    _chosen(decisions, "body", F.col("message_body")).alias("body"),
                    _chosen(decisions, "actor", F.lit(actor)).alias("created_by"),
                    as_of.alias("created_at"), F.lit(OUTGOING_STATUS).alias("status")))


def followup_actions(decisions: DataFrame, actor: str, as_of: Column,
                     template: FollowupTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Audit rows ``followup_sent``: the issues as old values, the message
    address and subject as new values."""
    missing = F.transform(F.col("issues"),
                          lambda i: F.struct(i["field"].alias("field"), i["error"].alias("error")))
    old_values = F.to_json(F.struct(missing.alias("missing_fields")))
    new_values = F.to_json(F.struct(F.struct(F.col("sender").alias("to"),
                                             _chosen(decisions, "subject", F.lit(template.subject))
                                             .alias("subject"))
                                    .alias("followup_email")), {"ignoreNullFields": "false"})
    return (decisions.where(F.col("decision") == FOLLOWUP)
            .select("email_id", F.lit(ACTION_FOLLOWUP).alias("action"),
                    _chosen(decisions, "actor", F.lit(actor)).alias("actor_email"), old_values.alias("old_values"),
                    new_values.alias("new_values"), F.lit(FOLLOWUP_REASON).alias("reason"),
                    as_of.alias("created_at")))


def audit_rows(decisions: DataFrame, actor: str, as_of: Column,
               template: FollowupTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """All audit rows of one decision run (confirmations and follow-ups)."""
    return confirm_actions(decisions, actor, as_of).unionByName(
        followup_actions(decisions, actor, as_of, template))


def batch_approve(decisions: DataFrame, actor: str, as_of: Column,
                  body: str = "email_body") -> DataFrame:
    """Approved changes for the records that passed the pipeline outright."""
    return approved_rows(decisions.where(F.col("validation_status") == "PASS"), actor, as_of, body)


def auto_approvable(decisions: DataFrame) -> DataFrame:
    """Decisions that need no reviewer: confirmed records whose pipeline checks
    all passed (status PASS)."""
    return decisions.where((F.col("decision") == CONFIRM) & (F.col("validation_status") == "PASS"))


def auto_actions(decisions: DataFrame, actor: str, as_of: Column) -> DataFrame:
    """Audit rows ``auto_approved``, with the approved values as JSON."""
    return confirm_actions(auto_approvable(decisions), actor, as_of).withColumns(
        {"action": F.lit(ACTION_AUTO), "reason": F.lit(AUTO_REASON)})


def followup_from_errors(queue_rows: DataFrame, template: FollowupTemplate = DEFAULT_TEMPLATE,
                         errors: str = "errors") -> DataFrame:
    """Follow-up text from the queue's error array (NULL slots skipped)."""
    lines = _lines(F.array_compact(F.col(errors)), template.error_line, {"error": ""})
    body = render(template.body, {"first_name": _greeting_name(template),
                                  "account": _account_ref(template), "issues": lines,
                                  "reply_form": F.lit(reply_form())})
    return queue_rows.select("email_id", F.col("sender").alias("to_email"),
                             F.lit(template.subject).alias("subject"), body.alias("body"))


CORRECTABLE = ("sap_id", "contact_name", "contact_email", "contact_phone")


def merge_corrections(records: DataFrame, edits: DataFrame, key: str = "email_id",
                      fields: tuple[str, ...] = CORRECTABLE, ts: str | None = None) -> DataFrame:
    """Reviewer edits win where given (non-NULL, non-empty); adds
    ``changed_fields``. Of several edits of one field the latest by ``ts``
    counts (the largest text, without ``ts`` or at the same time)."""
    def latest(f: str) -> Column:
        value = F.nullif(F.col(f), F.lit(""))
        if ts is None:
            return F.max(value)
        return F.max(F.when(value.isNotNull(), F.struct(F.col(ts), value.alias("v"))))["v"]

    e = edits.groupBy(F.col(key).alias("_edit_key")).agg(*[latest(f).alias(f"_edit_{f}") for f in fields])
    joined = lookup(records, e, key, "_edit_key")
    merged = {f: F.coalesce(F.col(f"_edit_{f}"), F.col(f)) for f in fields}
    changed = F.array_compact(F.array(*[
        F.when(~merged[f].eqNullSafe(F.col(f)), F.lit(f)) for f in fields]))
    return (joined.withColumn("changed_fields", changed).withColumns(merged)
            .drop(*[f"_edit_{f}" for f in fields]))
