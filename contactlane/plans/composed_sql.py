"""The whole intake as one SQL statement over the registered functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.sqlfuncs import register_functions


def review_records_sql(emails_table: str, directory_table: str, prefix: str = "fn_") -> str:
    """One statement: each message's fields are extracted and checked, the id
    is looked up, then the record is routed and packed; the packed record is
    unpacked into the review columns. The lookup is a join with the distinct
    ids; a message without a valid id gets a key of its own that no account
    has, so that such messages spread over all partitions. The key is a struct,
    so the distinct ids are dealt out once more for the join, and Spark can split
    an account that holds a large share of the messages."""
    f = prefix
    return f"""
WITH checked AS (
  SELECT email_id, sender, x.sap_id, x.contact_name, x.contact_email, x.contact_phone,
         {f}validate_sap_id(x.sap_id) AS v_id, {f}validate_name(x.contact_name) AS v_name,
         {f}validate_email(x.contact_email) AS v_mail, {f}validate_phone(x.contact_phone) AS v_tel
  FROM (SELECT email_id, sender, {f}extract_email(body) AS x FROM {emails_table})
),
accounts AS (SELECT named_struct('id', account) AS account
             FROM (SELECT DISTINCT upper(sap_id) AS account FROM {directory_table} WHERE sap_id IS NOT NULL)),
known AS (SELECT c.*, account IS NOT NULL AS in_directory
          FROM checked c LEFT JOIN accounts
            ON account = named_struct('id', coalesce(upper(v_id.normalized), concat('no id ', xxhash64(email_id, sender)))))
SELECT rec.email_id, rec.sender, rec.validation_status, rec.queue_type, rec.normalized_sap_id,
       rec.normalized_name, rec.contact_email, rec.normalized_phone, rec.sap_exists
FROM (
  SELECT {f}build_review_record(
           email_id, sender, sap_id, contact_name, contact_email, contact_phone,
           v_id.normalized, v_name.normalized, v_tel.normalized,
           v_id.is_valid, v_name.is_valid, v_mail.is_valid, v_tel.is_valid, in_directory,
           route.validation_status, route.queue_type) AS rec
  FROM (SELECT *, {f}route_validation(v_id.is_valid, v_name.is_valid, v_mail.is_valid,
                                      v_tel.is_valid, in_directory) AS route
        FROM known)
)"""


def review_records(spark: SparkSession, emails: DataFrame, directory: DataFrame,
                   prefix: str = "fn_") -> DataFrame:
    """Run the composed statement over ``emails`` with ``directory`` as lookup."""
    emails.createOrReplaceTempView("_cl_emails")
    directory.createOrReplaceTempView("_cl_directory")
    register_functions(spark, "_cl_directory", prefix)
    return spark.sql(review_records_sql("_cl_emails", "_cl_directory", prefix))
