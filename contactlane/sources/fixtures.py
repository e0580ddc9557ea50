"""Deterministic intake/review relations derived from the driver's tables.

The reference ships neither its e-mails nor its directory, so the jobs are
exercised on relations Spark derives from the TPC-H-like tables: customers
become e-mails with clean, messy and incomplete fields; orders give the
account directory; events give the review action log. Every relation grows
with its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

# Fixed stamp for every run-time timestamp, so results can be compared.
AS_OF = "2024-01-01 00:00:00"


def as_of_sql(as_of: str = AS_OF) -> str:
    return f"TIMESTAMP_NTZ '{as_of}'"


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_fields``: one request per customer with field variants."""
    return spark.sql("""
        SELECT 'EMAIL-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS email_id,
               'sender' || CAST(c_custkey AS STRING) || '@mail' || CAST(c_nationkey AS STRING)
                 || '.example.com' AS sender,
               c_custkey,
               CASE c_custkey % 12 WHEN 1 THEN 'sap' || lpad(CAST(c_custkey AS STRING), 6, '0')
                    WHEN 2 THEN '  SAP' || lpad(CAST(c_custkey AS STRING), 6, '0') || ' '
                    WHEN 3 THEN 'SAP' || lpad(CAST(c_custkey AS STRING), 5, '0')
                    WHEN 4 THEN NULL
                    WHEN 5 THEN 'SAP-' || lpad(CAST(c_custkey AS STRING), 6, '0')
                    ELSE 'SAP' || lpad(CAST(c_custkey AS STRING), 6, '0') END AS sap_id,
               CASE c_custkey % 13 WHEN 1 THEN 'mary-jane o''brien' WHEN 2 THEN '  JOHN  SMITH '
                    WHEN 3 THEN 'Cher' WHEN 4 THEN '' WHEN 5 THEN 'X'
                    WHEN 6 THEN '3rd party mcdonald'
                    ELSE 'anna ' || lower(c_mktsegment) END AS contact_name,
               CASE c_custkey % 17 WHEN 1 THEN 'not-an-email'
                    WHEN 2 THEN ' user' || CAST(c_custkey AS STRING) || '@example.org '
                    WHEN 3 THEN NULL WHEN 4 THEN 'user@localhost'
                    ELSE 'user' || CAST(c_custkey AS STRING) || '@example.org' END AS contact_email,
               CASE c_custkey % 19
                    WHEN 1 THEN '+1 (' || CAST(201 + c_custkey % 700 AS STRING) || ') 555-'
                      || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
                    WHEN 2 THEN '555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
                    WHEN 3 THEN '055-555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
                    WHEN 4 THEN '   ' WHEN 5 THEN 'call me'
                    ELSE CAST(201 + c_custkey % 700 AS STRING) || '.555.'
                      || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS contact_phone
        FROM {customer}""", customer=read_table(spark, sf_dir, "customer"))


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_emails``: bodies in three layouts (inline labels, label lines, prose)."""
    return spark.sql("""
        SELECT email_id, sender, sap_id, contact_name, contact_email, contact_phone, c_custkey,
          CASE c_custkey % 3
            WHEN 0 THEN 'Good day, these are my new contact details.'
                 || coalesce(' Name: ' || contact_name, '') || coalesce(' SAP ID: ' || sap_id, '')
                 || coalesce(' Email: ' || contact_email, '')
                 || coalesce(' Phone: ' || contact_phone, '') || ' Thank you!'
            WHEN 1 THEN 'Hi team,' || chr(10) || coalesce('SAP Account ID: ' || sap_id || chr(10), '')
                 || coalesce('Contact Name: ' || contact_name || chr(10), '')
                 || coalesce('Contact Email: ' || contact_email || chr(10), '')
                 || coalesce('Contact Phone: ' || contact_phone || chr(10), '') || 'Regards'
            ELSE 'Please change my details, no form attached. ' || coalesce(contact_email, '')
          END AS body
        FROM {fx_fields}""", fx_fields=fields(spark, sf_dir))


def directory_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw account ids known to the directory: customers with a finished order
    (the one rule, which leaves some customers out)."""
    return spark.sql("""
        SELECT 'SAP' || lpad(CAST(o_custkey AS STRING), 6, '0') AS sap_id
        FROM {orders} WHERE o_orderstatus = 'F'""",
                     orders=read_table(spark, sf_dir, "orders"))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_actions``: the review action log (many rows per e-mail), one row for
    each event. Customers without events have no action yet."""
    return spark.sql("""
        SELECT 'EMAIL-' || lpad(CAST(user_id AS STRING), 8, '0') AS email_id,
               CASE event_type WHEN 'purchase' THEN 'confirmed' WHEN 'error' THEN 'followup_sent'
                    ELSE event_type END AS action,
               'reviewer' || CAST(event_id % 7 AS STRING) || '@example.com' AS actor_email,
               CASE WHEN event_type = 'error' THEN 'Missing or invalid fields' END AS reason,
               ts AS created_at, event_id
        FROM {events}""", events=read_table(spark, sf_dir, "events"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction responses as JSON text; every 23rd one is cut short (broken)."""
    return spark.sql("""
        SELECT email_id, sender, body,
               CASE WHEN c_custkey % 23 = 0 THEN substring(j, 1, length(j) - 1) ELSE j END AS response
        FROM (SELECT email_id, sender, body, c_custkey,
                     to_json(named_struct('sap_id', sap_id, 'contact_name', contact_name,
                                          'contact_email', contact_email,
                                          'contact_phone', contact_phone)) AS j
              FROM {fx_emails})""", fx_emails=emails(spark, sf_dir))


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewer edits: every 7th e-mail gets one corrected field."""
    return spark.sql("""
        SELECT 'EMAIL-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS email_id,
               CASE WHEN (c_custkey DIV 7) % 4 = 0
                    THEN 'SAP' || lpad(CAST(c_custkey AS STRING), 6, '0') END AS sap_id,
               CASE WHEN (c_custkey DIV 7) % 4 = 1 THEN 'alex ' || lower(c_mktsegment) END AS contact_name,
               CASE WHEN (c_custkey DIV 7) % 4 = 2
                    THEN 'fixed' || CAST(c_custkey AS STRING) || '@example.net' END AS contact_email,
               CASE WHEN (c_custkey DIV 7) % 4 = 3
                    THEN '(212) 555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS contact_phone
        FROM {customer} WHERE c_custkey % 7 = 0""", customer=read_table(spark, sf_dir, "customer"))


def choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reviewer's picks: two e-mails in three, some with an edited message."""
    return spark.sql("""
        SELECT 'EMAIL-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS email_id,
               CASE WHEN c_custkey % 4 <> 0
                    THEN 'picker' || CAST(c_nationkey AS STRING) || '@example.com' END AS actor,
               CASE WHEN c_custkey % 5 = 1 THEN 'About account ' || CAST(c_custkey AS STRING) END AS subject,
               CASE WHEN c_custkey % 5 IN (1, 2) THEN 'Please call us, ' || lower(c_mktsegment) END AS body
        FROM {customer} WHERE c_custkey % 3 <> 0""", customer=read_table(spark, sf_dir, "customer"))


def outgoing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_outgoing``: follow-up messages sent over time, several per e-mail."""
    return spark.sql("""
        SELECT 'EMAIL-' || lpad(CAST(user_id AS STRING), 8, '0') AS email_id,
               'sender' || CAST(user_id AS STRING) || '@example.net' AS to_email,
               'Reminder ' || CAST(event_id % 5 AS STRING) AS subject,
               'Message ' || CAST(event_id AS STRING) AS body,
               'reviewer' || CAST(event_id % 7 AS STRING) || '@example.com' AS created_by,
               ts AS created_at, 'pending' AS status
        FROM {events}""", events=read_table(spark, sf_dir, "events"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")
