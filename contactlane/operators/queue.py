"""Review-side reads of the queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import joins
from .routing import FAIL, NEEDS_REVIEW, PASS

# Fixed value: the columns of the pending list, in order.
PENDING_COLUMNS = ("email_id", "sender", "validation_status", "sap_id", "contact_name",
                   "contact_email", "contact_phone", "normalized_sap_id", "normalized_name",
                   "normalized_phone", "sap_id_valid", "name_valid", "email_valid",
                   "phone_valid", "sap_exists")
SEARCH_COLUMNS = ("email_id", "sender", "sap_id", "normalized_sap_id")

# ---------------------------------------------------------------------------
# Status marks of the pending list, and the badge per status.
STATUS_MARKS = {"PASS": "✅", "NEEDS_REVIEW": "⚠️", "FAIL": "❌"}
STATUS_BADGES = {
    "PASS": ("Complete", "All fields extracted successfully"),
    "NEEDS_REVIEW": ("Needs Review", "SAP ID not found in database"),
    "FAIL": ("Incomplete", "Missing or invalid fields"),
}
# ---------------------------------------------------------------------------


def pending(queue: DataFrame, actions: DataFrame) -> DataFrame:
    """Queue rows no action has been taken on (anti-join on ``email_id``).

    The action log is reduced to distinct ids with partial aggregation before
    the shuffle; a queue row with a NULL id is kept.
    """
    return joins.anti_join(queue, actions, "email_id", "email_id")


def search_filter(query: str | None, mode: str = "contains",
                  columns: tuple[str, ...] = SEARCH_COLUMNS) -> Column | None:
    """OR over ``columns``; blank query -> no filter.

    ``contains`` matches the text literally; ``like`` pastes it into
    ``LIKE '%q%'`` so ``%`` and ``_`` act as wildcards. Both are
    case-sensitive; a NULL column does not match but does not hide a hit in
    another column.
    """
    if not query:
        return None
    if mode == "like":
        preds = [F.col(c).like(f"%{query}%") for c in columns]
    elif mode == "contains":
        preds = [F.col(c).contains(F.lit(query)) for c in columns]
    else:
        raise ValueError(f"unknown search mode {mode!r}")
    cond = preds[0]
    for p in preds[1:]:
        cond = cond | p
    return cond


def pending_items(queue: DataFrame, actions: DataFrame, search: str | None = None,
                  mode: str = "contains", limit: int | None = None) -> DataFrame:
    """The pending list: 15 columns, ``validation_status DESC, email_id``.

    With ``limit`` it is a top-k (per-partition top-k, then one merge).
    """
    out = pending(queue, actions).select(*PENDING_COLUMNS)
    cond = search_filter(search, mode)
    if cond is not None:
        out = out.where(cond)
    out = out.orderBy(F.col("validation_status").desc(), F.col("email_id").asc())
    return out.limit(limit) if limit is not None else out


def kpi_counts(pending_rows: DataFrame) -> DataFrame:
    """One row: total pending, and pending per status (total counts all)."""
    status = F.col("validation_status")
    return pending_rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == PASS).alias("pass"),
        F.count_if(status == NEEDS_REVIEW).alias("needs_review"),
        F.count_if(status == FAIL).alias("fail"))


def needs_review_view(queue: DataFrame) -> DataFrame:
    """Detailed-review and rejected rows, by status then id."""
    return (queue.where(F.col("queue_type").isin("detailed_review", "rejected"))
            .select("email_id", "validation_status", "queue_type", "sap_id", "contact_name",
                    "contact_email", "contact_phone", "normalized_sap_id", "normalized_name",
                    "normalized_phone", "errors")
            .orderBy("validation_status", "email_id"))


def auto_approve_view(queue: DataFrame) -> DataFrame:
    """Quick-approval rows, by id; the normalised phone is the contact phone."""
    return (queue.where(F.col("queue_type") == "quick_approval")
            .select("email_id", "validation_status", "normalized_sap_id", "normalized_name",
                    F.col("normalized_phone").alias("contact_phone"), "contact_email",
                    "queued_at")
            .orderBy("email_id"))


def with_body(rows: DataFrame, emails: DataFrame, body: str = "body",
              out: str = "email_body") -> DataFrame:
    """The original body per row (one body per id -- the smallest if an
    id repeats; NULL when unknown).

    Only bodies of the ids in ``rows`` are kept before they are aggregated
    and joined, so call it on the rows that need a body, not on all.
    """
    wanted = joins.semi_join(emails.select(F.col("email_id").alias("_b_id"), body),
                             rows, "_b_id", "email_id")
    bodies = joins.one_per_key(wanted, "_b_id", body, out)
    return joins.lookup(rows, bodies, "email_id", "_b_id")


def _lookup(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def status_labels(df: DataFrame, status: str = "validation_status") -> DataFrame:
    """``status_display`` (mark + status, unknown -> blank mark) and the badge."""
    mark = F.coalesce(_lookup(STATUS_MARKS)[F.col(status)], F.lit(""))
    title = _lookup({k: v[0] for k, v in STATUS_BADGES.items()})[F.col(status)]
    detail = _lookup({k: v[1] for k, v in STATUS_BADGES.items()})[F.col(status)]
    fallback = STATUS_BADGES[FAIL]
    return df.withColumns({
        "status_display": F.concat(mark, F.lit(" "), F.col(status)),
        "badge_title": F.coalesce(title, F.lit(fallback[0])),
        "badge_detail": F.coalesce(detail, F.lit(fallback[1])),
    })
