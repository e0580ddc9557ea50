"""Table schemas of the intake and review tables.

Timestamps are wall-clock UTC without a zone (TIMESTAMP_NTZ), the type the
driver's Parquet ``ts`` columns load as, so stamps compare across engines.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, B, TS = T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EMAILS = _struct(("email_id", S), ("sender", S), ("body", S), ("sap_id", S))

DIRECTORY = _struct(("sap_id", S), ("account_status", S), ("last_updated", TS))

EXTRACTED = _struct(("email_id", S), ("sender", S), ("email_body", S), ("sap_id", S),
                    ("contact_name", S), ("contact_email", S), ("contact_phone", S),
                    ("extraction_error", S))

REVIEW_QUEUE = _struct(
    ("email_id", S), ("sender", S), ("validation_status", S), ("queue_type", S),
    ("sap_id", S), ("contact_name", S), ("contact_email", S), ("contact_phone", S),
    ("normalized_sap_id", S), ("normalized_name", S), ("normalized_phone", S),
    ("sap_id_valid", B), ("name_valid", B), ("email_valid", B), ("phone_valid", B),
    ("sap_exists", B), ("errors", T.ArrayType(S, True)), ("queued_at", TS))

REVIEW_ACTIONS = _struct(("email_id", S), ("action", S), ("actor_email", S),
                         ("old_values", S), ("new_values", S), ("reason", S),
                         ("created_at", TS))

APPROVED_CHANGES = _struct(("email_id", S), ("sap_id", S), ("contact_name", S),
                           ("contact_email", S), ("contact_phone", S),
                           ("source_email_body", S), ("approved_by", S),
                           ("approved_at", TS))

OUTGOING_EMAILS = _struct(("email_id", S), ("to_email", S), ("subject", S), ("body", S),
                          ("created_by", S), ("created_at", TS), ("status", S))

ISSUE = _struct(("field", S), ("code", S), ("error", S))

# Output tables of the review side, created when missing.
REVIEW_OUTPUTS = {"review_actions": REVIEW_ACTIONS,
                  "approved_changes": APPROVED_CHANGES,
                  "auto_approved": APPROVED_CHANGES,
                  "outgoing_emails": OUTGOING_EMAILS}


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema)
