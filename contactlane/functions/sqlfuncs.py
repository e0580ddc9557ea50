"""The rules, lookup, routing, extraction and packaging as SQL functions.

Bodies are the same SQL expressions the DataFrame jobs use, registered with
``CREATE FUNCTION ... RETURN expr``; Spark inlines them into the calling plan,
so a SQL statement composed of them runs as native expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import extract as X
from ..operators import routing as G
from . import rules as R

EXTRACTION_TYPE = ("STRUCT<sap_id: STRING, contact_name: STRING, contact_email: STRING, "
                   "contact_phone: STRING, request_type: STRING, raw: STRING, error: STRING>")
# Parameter order of the packaging function (its result puts status first).
RECORD_PARAMS = ("email_id", "sender", "sap_id", "contact_name", "contact_email", "contact_phone",
                 "normalized_sap_id", "normalized_name", "normalized_phone", "sap_id_valid",
                 "name_valid", "email_valid", "phone_valid", "sap_exists", "validation_status",
                 "queue_type")
_RECORD_TYPES = {"sap_id_valid": "BOOLEAN", "name_valid": "BOOLEAN", "email_valid": "BOOLEAN",
                 "phone_valid": "BOOLEAN", "sap_exists": "BOOLEAN"}


def _create(spark: SparkSession, name: str, params: str, returns: str, body: str,
            temporary: bool) -> None:
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    spark.sql(f"CREATE OR REPLACE {kind} {name}({params}) RETURNS {returns} RETURN {body}")


def register_functions(spark: SparkSession, directory_table: str = "contact_directory",
                       prefix: str = "fn_", temporary: bool = True) -> list[str]:
    """Register the eight functions; ``directory_table`` names the directory
    (a table or view with column ``sap_id``). Returns the function names."""
    names = []

    def reg(short: str, params: str, returns: str, body: str) -> None:
        _create(spark, prefix + short, params, returns, body, temporary)
        names.append(prefix + short)

    def p(fn: str, arg: str) -> str:
        return f"{prefix}{fn}.{arg}"

    reg("validate_email", "email STRING", R.EMAIL_VALIDATION_TYPE,
        R.EMAIL.inline_struct(p("validate_email", "email")))
    reg("validate_phone", "phone STRING", R.VALIDATION_TYPE,
        R.PHONE.inline_struct(p("validate_phone", "phone")))
    reg("validate_sap_id", "sap_id STRING", R.VALIDATION_TYPE,
        R.ACCOUNT_ID.inline_struct(p("validate_sap_id", "sap_id")))
    reg("validate_name", "name STRING", R.VALIDATION_TYPE,
        R.NAME.inline_struct(p("validate_name", "name")))
    reg("sap_exists", "sap_id STRING", "BOOLEAN",
        f"(SELECT COUNT(*) > 0 FROM {directory_table} d "
        f"WHERE d.sap_id = UPPER({p('sap_exists', 'sap_id')}))")
    reg("route_validation",
        "sap_ok BOOLEAN, name_ok BOOLEAN, email_ok BOOLEAN, phone_ok BOOLEAN, exists BOOLEAN",
        G.ROUTING_TYPE,
        G.route_sql(*[p("route_validation", a)
                      for a in ("sap_ok", "name_ok", "email_ok", "phone_ok", "exists")]))
    reg("extract_email", "body STRING", EXTRACTION_TYPE,
        X.extract_struct_sql(p("extract_email", "body")))
    params = ", ".join(f"{f} {_RECORD_TYPES.get(f, 'STRING')}" for f in RECORD_PARAMS)
    returns = "STRUCT<" + ", ".join(f"{f}: {_RECORD_TYPES.get(f, 'STRING')}"
                                    for f in G.REVIEW_RECORD_FIELDS) + ">"
    body = "named_struct(" + ", ".join(f"'{f}', {p('build_review_record', f)}"
                                       for f in G.REVIEW_RECORD_FIELDS) + ")"
    reg("build_review_record", params, returns, body)
    return names
