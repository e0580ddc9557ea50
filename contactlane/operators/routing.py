"""Routing and the review-queue record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.sqltext import sql_string

# Statuses and the queue each one goes to.
PASS, NEEDS_REVIEW, FAIL = "PASS", "NEEDS_REVIEW", "FAIL"
QUEUE_OF = {PASS: "quick_approval", NEEDS_REVIEW: "detailed_review", FAIL: "rejected"}

FLAGS = ("sap_id_valid", "name_valid", "email_valid", "phone_valid")

QUEUE_COLUMNS = ("email_id", "sender", "validation_status", "queue_type",
                 "sap_id", "contact_name", "contact_email", "contact_phone",
                 "normalized_sap_id", "normalized_name", "normalized_phone",
                 "sap_id_valid", "name_valid", "email_valid", "phone_valid", "sap_exists",
                 "errors", "queued_at")

ROUTING_TYPE = "STRUCT<validation_status: STRING, queue_type: STRING>"


def route_sql(sap_ok: str, name_ok: str, email_ok: str, phone_ok: str, exists: str) -> str:
    """All four valid and known -> PASS; all valid, unknown -> NEEDS_REVIEW;
    otherwise (any invalid or NULL flag) FAIL. Returns the routing struct."""
    fields_ok = f"{sap_ok} AND {name_ok} AND {email_ok} AND {phone_ok}"

    def out(status: str) -> str:
        return (f"named_struct('validation_status', {sql_string(status)}, "
                f"'queue_type', {sql_string(QUEUE_OF[status])})")
    return (f"CASE WHEN {fields_ok} AND {exists} THEN {out(PASS)} "
            f"WHEN {fields_ok} AND NOT {exists} THEN {out(NEEDS_REVIEW)} "
            f"ELSE {out(FAIL)} END")


def route(df: DataFrame, exists: str = "sap_exists") -> DataFrame:
    """Add ``validation_status`` and ``queue_type``."""
    routing = F.expr(route_sql(*FLAGS, exists))
    return df.withColumn("_routing", routing).withColumns({
        "validation_status": F.col("_routing.validation_status"),
        "queue_type": F.col("_routing.queue_type")}).drop("_routing")


def positional_errors(exists: str = "sap_exists"):
    """Five slots: the four field errors where the flag is false, then the
    directory miss for a well-formed id. Fine slots stay NULL."""
    return F.array(
        F.when(~F.col("sap_id_valid"), F.col("sap_validation.error")),
        F.when(~F.col("name_valid"), F.col("name_validation.error")),
        F.when(~F.col("email_valid"), F.col("email_validation.error")),
        F.when(~F.col("phone_valid"), F.col("phone_validation.error")),
        F.when(F.col("sap_id_valid") & ~F.col(exists),
               F.lit(R.PIPELINE_MESSAGES["sap_id.unknown"])))


def review_queue(routed: DataFrame, as_of) -> DataFrame:
    """The 18-column queue row; ``queued_at`` is the run's stamp."""
    return routed.withColumns({"errors": positional_errors(), "queued_at": as_of}) \
        .select(*QUEUE_COLUMNS)


def compact_errors(df: DataFrame, errors: str = "errors", out: str = "errors_compact") -> DataFrame:
    """The non-NULL errors only, in order."""
    return df.withColumn(out, F.array_compact(F.col(errors)))


def routing_summary(routed: DataFrame) -> DataFrame:
    """Count per status and queue, ordered by queue."""
    return (routed.groupBy("validation_status", "queue_type")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("queue_type"))


REVIEW_RECORD_FIELDS = ("email_id", "sender", "validation_status", "queue_type",
                        "sap_id", "contact_name", "contact_email", "contact_phone",
                        "normalized_sap_id", "normalized_name", "normalized_phone",
                        "sap_id_valid", "name_valid", "email_valid", "phone_valid",
                        "sap_exists")


def review_record(df: DataFrame, out: str = "review_record") -> DataFrame:
    """Pack the 16 review fields into one struct column."""
    return df.withColumn(out, F.struct(*[F.col(c) for c in REVIEW_RECORD_FIELDS]))
