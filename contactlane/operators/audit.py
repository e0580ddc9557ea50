"""Audit-log and follow-up reports.

Top-k lists order by time with a tie-break so they are a total order.
Per-key "latest" and "first" use ``max_by``/``min_by`` aggregates, which
combine map-side, instead of ranking a whole key's rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import lookup
from ..sources.tables import export_csv, materialize
from .quantiles import exact_quantiles

# Display labels of audit actions (others shown as stored).
ACTION_LABELS = {"confirmed": "✅ Confirmed", "followup_sent": "📤 Follow-up Sent"}


def action_label(action: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for kv in ACTION_LABELS.items() for x in kv])
    return F.coalesce(labels[action], action)


def _order(ts: str, tie: Sequence[str]) -> list[Column]:
    return [F.col(ts).desc()] + [F.col(t).desc() for t in tie]


def audit_log(actions: DataFrame, limit: int | None = None,
              tie: Sequence[str] = ("email_id", "action")) -> DataFrame:
    """Recent actions with display labels, newest first."""
    out = (actions.select("email_id", action_label(F.col("action")).alias("action"),
                          "actor_email", "created_at", "reason", *[t for t in tie
                                                                   if t not in ("email_id", "action")])
           .orderBy(*_order("created_at", tie)))
    out = out.limit(limit) if limit is not None else out
    return out.select("email_id", "action", "actor_email", "created_at", "reason")


def followup_list(outgoing: DataFrame, limit: int | None = None,
                  tie: Sequence[str] = ("email_id",)) -> DataFrame:
    """Recent follow-up messages, newest first."""
    out = (outgoing.select("email_id", "to_email", "subject", "created_by", "created_at",
                           "status").orderBy(*_order("created_at", tie)))
    return out.limit(limit) if limit is not None else out


def latest_per_key(df: DataFrame, key: str, ts: str, values: Sequence[str],
                   tie: Sequence[str] = ()) -> DataFrame:
    """Per ``key`` the ``values`` of the row with the largest (ts, tie..., values...):
    a total order, so equal stamps give one result."""
    picked = F.max(F.struct(*[F.col(c) for c in (ts, *tie, *values)]))
    return (df.groupBy(key).agg(picked.alias("_latest"))
            .select(key, *[F.col(f"_latest.{c}").alias(c) for c in (ts, *tie, *values)]))


def latest_followup(outgoing: DataFrame) -> DataFrame:
    """Latest follow-up subject and body per e-mail."""
    return latest_per_key(outgoing, "email_id", "created_at", ["subject", "body"],
                          tie=("to_email",))


def first_action(actions: DataFrame, tie: str = "action") -> DataFrame:
    """Per e-mail: time and actor of its first action, and the number of actions."""
    order = F.struct(F.col("created_at"), F.col(tie))
    return actions.where(F.col("email_id").isNotNull()).groupBy("email_id").agg(
        F.min("created_at").alias("first_action_at"),
        F.min_by(F.col("actor_email"), order).alias("first_actor"),
        F.count(F.lit(1)).alias("n_actions"))


def exact_median(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """``by..., out``: the lower median of the non-NULL ``value`` per group, exactly."""
    return exact_quantiles(df, by, value, {out: 0.5})


# Shares of the items, and the columns their seconds come in.
QUANTILES = {"p50_seconds": 0.5}
TAIL_QUANTILES = {"p50_seconds": 0.5, "p90_seconds": 0.9, "p99_seconds": 0.99}


def turnaround(queue: DataFrame, actions: DataFrame, tie: str = "action",
               by: Sequence[str] = ("validation_status",),
               quantiles: Mapping[str, float] = QUANTILES) -> DataFrame:
    """R2: per status (or ``by``, e.g. status and ``first_actor``), how many
    items were acted on and how long after queueing the first action came
    (seconds; the quantiles are exact). The times are written once under the
    checkpoint folder, and everything else reads them there."""
    firsts = first_action(actions, tie).withColumnRenamed("email_id", "_fa_id")
    joined = lookup(queue.select("email_id", "validation_status", "queued_at"), firsts,
                    "email_id", "_fa_id")
    secs = F.expr("timestampdiff(MICROSECOND, queued_at, first_action_at)") / F.lit(1e6)
    timed = materialize(joined.withColumn("_secs", secs).select(*by, "_secs", "n_actions"), "turnaround")
    out = timed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count("_secs").alias("n_actioned"),
        F.sum("n_actions").cast("long").alias("n_actions"),
        F.round(F.avg("_secs"), 3).alias("avg_seconds"),
        F.round(F.min("_secs"), 3).alias("min_seconds"),
        F.round(F.max("_secs"), 3).alias("max_seconds"))
    found = exact_quantiles(timed, by, "_secs", quantiles).select(
        *[F.col(c).alias(f"_p_{c}") for c in by], *[F.round(q, 3).alias(q) for q in quantiles])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    return out.join(found, same, "left").drop(*[f"_p_{c}" for c in by])


def new_since(df: DataFrame, ts: str, since: Column, by: Sequence[str],
              date_partition: str | None = None) -> DataFrame:
    """Rows newer than ``since``, counted per group. With the name of a
    date partition column derived from ``ts``, older folders are not read."""
    cond = F.col(ts) > since
    if date_partition:
        cond = cond & (F.col(date_partition) >= F.to_date(since))
    return (df.where(cond).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n_new"), F.max(ts).alias("latest_at")))


def export_audit_log(actions: DataFrame, path: str, limit: int | None = None,
                     tie: Sequence[str] = ("email_id", "action")) -> None:
    """The audit view (labels, newest first) as CSV with a header."""
    export_csv(audit_log(actions, limit, tie), path)
