"""Oracle queries in DuckDB SQL, one per registered Spark query.

Written against DuckDB's own functions (RE2 regexes, list lambdas) over the
driver's tables, which DuckDB sees as views. The fixture relations are the
ASCII ones of FIXTURES.md, so ASCII character classes suffice here.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-01 00:00:00'"
ACTOR = "'reviewer@example.com'"
WS = r"[\s\x0b\x1c-\x1f]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '{WS}*'))"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)', 1), "
            f"lambda r: upper(substring(r, 1, 1)) || lower(substring(r, 2))), '')")


EMAIL_RE = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"

# The wording of the checks' messages.
PIPELINE = {
    "sap_id.empty": "'SAP ID is empty'",
    "sap_id.format": "'Invalid SAP ID format (expected SAPXXXXXX): ' || {x}",
    "name.empty": "'Name is empty'", "name.short": "'Name too short'",
    "name.parts": "'Name must include first and last name'",
    "email.empty": "'Email is empty'", "email.format": "'Invalid email format: ' || {x}",
    "phone.empty": "'Phone is empty'",
    "phone.length": "'Phone must have 10 digits, got ' || CAST(length({d}) AS VARCHAR)",
    "phone.area": "'Area code cannot start with 0 or 1'",
}
REVIEWER = dict(PIPELINE)
REVIEWER.update({
    "sap_id.empty": "'SAP ID is missing'",
    "sap_id.format": "'Invalid SAP ID format (expected SAPXXXXXX)'",
    "name.empty": "'Contact name is missing'",
    "email.format": "'Invalid email format'",
    "phone.empty": "'Phone number is missing'",
})


def rules_ctes(src: str, out: str, cols: dict[str, str], msgs: dict[str, str]) -> str:
    """CTEs adding, for p in sap/name/email/phone: p_code, p_valid, p_norm, p_error."""
    s, n, e, p = cols["sap"], cols["name"], cols["email"], cols["phone"]
    d0 = f"regexp_replace({p}, '[^0-9]', '', 'g')"
    stage1 = f"""{out}_h AS (
  SELECT *, upper({strip(s)}) AS _sap_clean, {strip(n)} AS _name_clean, {strip(e)} AS _email_clean,
         CASE WHEN length({d0}) = 11 AND substring({d0}, 1, 1) = '1' THEN substring({d0}, 2)
              ELSE {d0} END AS _phone_d
  FROM {src})"""
    stage2 = f"""{out}_c AS (
  SELECT *,
    CASE WHEN {blank(s)} THEN 'sap_id.empty'
         WHEN NOT regexp_full_match(_sap_clean, 'SAP[0-9]{{6}}') THEN 'sap_id.format' END AS sap_code,
    CASE WHEN {blank(n)} THEN 'name.empty' WHEN length(_name_clean) < 2 THEN 'name.short'
         WHEN NOT regexp_matches(_name_clean, '{WS}') THEN 'name.parts' END AS name_code,
    CASE WHEN {blank(e)} THEN 'email.empty'
         WHEN NOT regexp_full_match(_email_clean, '{EMAIL_RE}') THEN 'email.format' END AS email_code,
    CASE WHEN {blank(p)} THEN 'phone.empty' WHEN length(_phone_d) <> 10 THEN 'phone.length'
         WHEN substring(_phone_d, 1, 1) IN ('0', '1') THEN 'phone.area' END AS phone_code
  FROM {out}_h)"""

    def err(prefix: str, x: str, codes: list[str]) -> str:
        whens = " ".join(f"WHEN '{c}' THEN {msgs[c].format(x=x, d='_phone_d')}" for c in codes)
        return f"CASE {prefix}_code {whens} END AS {prefix}_error"

    stage3 = f"""{out} AS (
  SELECT *,
    sap_code IS NULL AS sap_valid, name_code IS NULL AS name_valid,
    email_code IS NULL AS email_valid, phone_code IS NULL AS phone_valid,
    CASE WHEN sap_code IS NULL THEN _sap_clean END AS sap_norm,
    CASE WHEN name_code IS NULL THEN {title('_name_clean')} END AS name_norm,
    CASE WHEN phone_code IS NULL THEN '(' || substring(_phone_d, 1, 3) || ') '
         || substring(_phone_d, 4, 3) || '-' || substring(_phone_d, 7, 4) END AS phone_norm,
    {err('sap', s, ['sap_id.empty', 'sap_id.format'])},
    {err('name', n, ['name.empty', 'name.short', 'name.parts'])},
    {err('email', e, ['email.empty', 'email.format'])},
    {err('phone', p, ['phone.empty', 'phone.length', 'phone.area'])}
  FROM {out}_c)"""
    return ",\n".join([stage1, stage2, stage3])


RAW = {"sap": "sap_id", "name": "contact_name", "email": "contact_email", "phone": "contact_phone"}

FX_FIELDS = """fx_fields AS (
SELECT 'EMAIL-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS email_id,
       'sender' || CAST(c_custkey AS STRING) || '@mail' || CAST(c_nationkey AS STRING) || '.example.com' AS sender,
       c_custkey,
       CASE c_custkey % 12 WHEN 1 THEN 'sap' || lpad(CAST(c_custkey AS STRING), 6, '0')
            WHEN 2 THEN '  SAP' || lpad(CAST(c_custkey AS STRING), 6, '0') || ' '
            WHEN 3 THEN 'SAP' || lpad(CAST(c_custkey AS STRING), 5, '0')
            WHEN 4 THEN NULL
            WHEN 5 THEN 'SAP-' || lpad(CAST(c_custkey AS STRING), 6, '0')
            ELSE 'SAP' || lpad(CAST(c_custkey AS STRING), 6, '0') END AS sap_id,
       CASE c_custkey % 13 WHEN 1 THEN 'mary-jane o''brien' WHEN 2 THEN '  JOHN  SMITH ' WHEN 3 THEN 'Cher'
            WHEN 4 THEN '' WHEN 5 THEN 'X' WHEN 6 THEN '3rd party mcdonald'
            ELSE 'anna ' || lower(c_mktsegment) END AS contact_name,
       CASE c_custkey % 17 WHEN 1 THEN 'not-an-email' WHEN 2 THEN ' user' || CAST(c_custkey AS STRING) || '@example.org '
            WHEN 3 THEN NULL WHEN 4 THEN 'user@localhost'
            ELSE 'user' || CAST(c_custkey AS STRING) || '@example.org' END AS contact_email,
       CASE c_custkey % 19 WHEN 1 THEN '+1 (' || CAST(201 + c_custkey % 700 AS STRING) || ') 555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
            WHEN 2 THEN '555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
            WHEN 3 THEN '055-555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
            WHEN 4 THEN '   ' WHEN 5 THEN 'call me'
            ELSE CAST(201 + c_custkey % 700 AS STRING) || '.555.' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS contact_phone
FROM customer)"""

FX_EMAILS = """fx_emails AS (
SELECT email_id, sender, sap_id, contact_name, contact_email, contact_phone, c_custkey,
 CASE c_custkey % 3
  WHEN 0 THEN 'Good day, these are my new contact details.' || coalesce(' Name: ' || contact_name, '') || coalesce(' SAP ID: ' || sap_id, '')
       || coalesce(' Email: ' || contact_email, '') || coalesce(' Phone: ' || contact_phone, '') || ' Thank you!'
  WHEN 1 THEN 'Hi team,' || chr(10) || coalesce('SAP Account ID: ' || sap_id || chr(10), '') || coalesce('Contact Name: ' || contact_name || chr(10), '')
       || coalesce('Contact Email: ' || contact_email || chr(10), '') || coalesce('Contact Phone: ' || contact_phone || chr(10), '') || 'Regards'
  ELSE 'Please change my details, no form attached. ' || coalesce(contact_email, '') END AS body
FROM fx_fields)"""

FX_DIRECTORY = """fx_directory AS (
SELECT DISTINCT upper(sap_id) AS sap_id FROM (
  SELECT 'SAP' || lpad(CAST(o_custkey AS STRING), 6, '0') AS sap_id
  FROM orders WHERE o_orderstatus = 'F') WHERE sap_id IS NOT NULL)"""

FX_ACTIONS = """fx_actions AS (
SELECT 'EMAIL-' || lpad(CAST(user_id AS STRING), 8, '0') AS email_id,
 CASE event_type WHEN 'purchase' THEN 'confirmed' WHEN 'error' THEN 'followup_sent' ELSE event_type END AS action,
 'reviewer' || CAST(event_id % 7 AS STRING) || '@example.com' AS actor_email,
 CASE WHEN event_type = 'error' THEN 'Missing or invalid fields' END AS reason,
 ts AS created_at, event_id
FROM events)"""

FX_OUTGOING = """fx_outgoing AS (
SELECT 'EMAIL-' || lpad(CAST(user_id AS STRING), 8, '0') AS email_id,
 'sender' || CAST(user_id AS STRING) || '@example.net' AS to_email,
 'Reminder ' || CAST(event_id % 5 AS STRING) AS subject, 'Message ' || CAST(event_id AS STRING) AS body,
 'reviewer' || CAST(event_id % 7 AS STRING) || '@example.com' AS created_by, ts AS created_at, 'pending' AS status
FROM events)"""

FX_CHOICES = """fx_choices AS (
SELECT 'EMAIL-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS email_id,
 CASE WHEN c_custkey % 4 <> 0 THEN 'picker' || CAST(c_nationkey AS STRING) || '@example.com' END AS actor,
 CASE WHEN c_custkey % 5 = 1 THEN 'About account ' || CAST(c_custkey AS STRING) END AS subject,
 CASE WHEN c_custkey % 5 IN (1, 2) THEN 'Please call us, ' || lower(c_mktsegment) END AS body
FROM customer WHERE c_custkey % 3 <> 0)"""

# Extraction by positions of plain texts: after a field's first label, up to
# the first text that can end a value.
STARTS = {"sap_id": ["SAP ID:", "SAP Account ID:"], "contact_name": ["Name:"], "contact_email": ["Email:"],
          "contact_phone": ["Phone:"], "request_type": ["Request Type:"]}
ENDS = ["SAP ID:", "SAP Account ID:", "Contact Name:", "Name:", "Contact Email:", "Email:", "Contact Phone:",
        "Phone:", "Request Type:", "Thank you"]


def label(body: str, field: str) -> str:
    at = [(f"strpos({body}, '{x}')", len(x)) for x in STARTS[field]]
    whens = " ".join(f"WHEN {p} > 0" + "".join(f" AND ({q} = 0 OR {p} < {q})" for q, _ in at if q != p)
                     + f" THEN substring({body}, {p} + {n})" for p, n in at)
    ends = ", ".join([f"nullif(strpos(r, '{e}'), 0)" for e in ENDS]
                     + ["nullif(strpos(r, chr(10)), 0)", "nullif(strpos(r, chr(13)), 0)"])
    value = f"CASE WHEN r IS NOT NULL THEN substring(r, 1, coalesce(list_min([{ends}]) - 1, length(r))) END"
    return f"nullif({strip(f'list_transform([CASE {whens} END], lambda r: {value})[1]')}, '')"


def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


EXTRACTED = f"""extracted AS (
SELECT email_id, sender, body,
  {label('body', 'sap_id')} AS sap_id, {label('body', 'contact_name')} AS contact_name,
  {label('body', 'contact_email')} AS contact_email, {label('body', 'contact_phone')} AS contact_phone,
  coalesce({label('body', 'request_type')}, 'account_update') AS request_type
FROM fx_emails),
extracted_e AS (
SELECT *, CASE WHEN body IS NULL THEN 'no_response'
  WHEN sap_id IS NULL AND contact_name IS NULL AND contact_email IS NULL AND contact_phone IS NULL
  THEN 'no_labelled_fields' END AS extraction_error FROM extracted)"""


def queue_ctes(src: str, out: str) -> str:
    """Validated + looked-up + routed queue over ``src`` (raw field columns)."""
    return rules_ctes(src, f"{out}_v", RAW, PIPELINE) + f""",
{out}_x AS (
  SELECT v.*, d.sap_id IS NOT NULL AS sap_exists
  FROM {out}_v v LEFT JOIN fx_directory d ON v.sap_norm = d.sap_id),
{out}_r AS (
  SELECT *,
    CASE WHEN sap_valid AND name_valid AND email_valid AND phone_valid AND sap_exists THEN 'PASS'
         WHEN sap_valid AND name_valid AND email_valid AND phone_valid AND NOT sap_exists THEN 'NEEDS_REVIEW'
         ELSE 'FAIL' END AS validation_status
  FROM {out}_x),
{out} AS (
  SELECT email_id, sender, validation_status,
    CASE validation_status WHEN 'PASS' THEN 'quick_approval' WHEN 'NEEDS_REVIEW' THEN 'detailed_review'
         ELSE 'rejected' END AS queue_type,
    sap_id, contact_name, contact_email, contact_phone,
    sap_norm AS normalized_sap_id, name_norm AS normalized_name, phone_norm AS normalized_phone,
    sap_valid AS sap_id_valid, name_valid, email_valid, phone_valid, sap_exists,
    CASE WHEN NOT sap_valid THEN sap_error END AS e1, CASE WHEN NOT name_valid THEN name_error END AS e2,
    CASE WHEN NOT email_valid THEN email_error END AS e3, CASE WHEN NOT phone_valid THEN phone_error END AS e4,
    CASE WHEN sap_valid AND NOT sap_exists THEN 'SAP ID not found in database' END AS e5,
    {AS_OF} AS queued_at
  FROM {out}_r)"""


def positional(prefix: str = "") -> str:
    return ("concat_ws('|', " + ", ".join(f"coalesce({prefix}e{i}, '')" for i in range(1, 6)) + ")")


def compact(prefix: str = "") -> str:
    return "concat_ws('|', " + ", ".join(f"{prefix}e{i}" for i in range(1, 6)) + ")"


QUEUE_COLS = ("email_id, sender, validation_status, queue_type, sap_id, contact_name, contact_email, "
              "contact_phone, normalized_sap_id, normalized_name, normalized_phone, sap_id_valid, "
              "name_valid, email_valid, phone_valid, sap_exists")
PENDING_COLS = ("email_id, sender, validation_status, sap_id, contact_name, contact_email, contact_phone, "
                "normalized_sap_id, normalized_name, normalized_phone, sap_id_valid, name_valid, "
                "email_valid, phone_valid, sap_exists")

DIRECT = f"WITH {FX_FIELDS},\n{FX_DIRECTORY},\n{queue_ctes('fx_fields', 'q')}\n"
EXTRACTED_Q = (f"WITH {FX_FIELDS},\n{FX_EMAILS},\n{FX_DIRECTORY},\n{FX_ACTIONS},\n{EXTRACTED},\n"
               f"{queue_ctes('extracted_e', 'q')},\n"
               "pending AS (SELECT * FROM q WHERE NOT EXISTS "
               "(SELECT 1 FROM fx_actions a WHERE a.email_id = q.email_id))\n")

DECIDE = """pref AS (
  SELECT p.* EXCLUDE (sap_id_valid, name_valid, email_valid, phone_valid),
    coalesce(nullif(normalized_sap_id, ''), nullif(sap_id, ''), '') AS sap_value,
    coalesce(nullif(normalized_name, ''), nullif(contact_name, ''), '') AS name_value,
    coalesce(nullif(contact_email, ''), '') AS email_value,
    coalesce(nullif(normalized_phone, ''), nullif(contact_phone, ''), '') AS phone_value
  FROM {src} p),
""" + rules_ctes("pref", "rv", {"sap": "sap_value", "name": "name_value", "email": "email_value",
                                "phone": "phone_value"}, REVIEWER) + """,
dec AS (
  SELECT rv.email_id, rv.sender, rv.validation_status, rv.sap_id, rv.contact_name,
    rv.normalized_sap_id, sap_value, name_value, email_value, phone_value,
    sap_valid AND name_valid AND email_valid AND phone_valid AS all_valid,
    CASE WHEN sap_valid AND name_valid AND email_valid AND phone_valid AND coalesce(sap_exists, false)
         THEN 'confirm' ELSE 'followup' END AS decision,
    sap_norm AS final_sap_id, name_norm AS final_name, phone_norm AS final_phone,
    list_filter([CASE WHEN NOT sap_valid THEN {'field': 'SAP ID', 'error': sap_error} END,
                 CASE WHEN NOT name_valid THEN {'field': 'Contact Name', 'error': name_error} END,
                 CASE WHEN NOT email_valid THEN {'field': 'Email', 'error': email_error} END,
                 CASE WHEN NOT phone_valid THEN {'field': 'Phone', 'error': phone_error} END],
                lambda i: i IS NOT NULL) AS issues,
    b.email_body
  FROM rv LEFT JOIN (SELECT email_id, min(body) AS email_body FROM fx_emails GROUP BY email_id) b
    ON rv.email_id = b.email_id)
"""



def decided(src: str = "pending") -> str:
    return DECIDE.replace("{src}", src)


DECISIONS = EXTRACTED_Q.rstrip("\n") + ",\n" + decided()
CHOSEN = (EXTRACTED_Q.rstrip("\n") + f",\n{FX_CHOICES},\n" + """picked AS (
  SELECT p.*, c.actor AS chosen_actor, c.subject AS chosen_subject, c.body AS chosen_body
  FROM pending p JOIN fx_choices c ON p.email_id = c.email_id),
""" + decided("picked").rstrip("\n") + """,
chosen AS (SELECT dec.*, p.chosen_actor, p.chosen_subject, p.chosen_body FROM dec JOIN picked p USING (email_id))
""")
ALL_DECISIONS = EXTRACTED_Q.rstrip("\n") + ",\n" + decided("q")

CORRECTED = EXTRACTED_Q.rstrip("\n") + """,
corr AS (SELECT 'EMAIL-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS email_id,
  CASE WHEN (c_custkey // 7) % 4 = 0 THEN 'SAP' || lpad(CAST(c_custkey AS STRING), 6, '0') END AS e_sap,
  CASE WHEN (c_custkey // 7) % 4 = 1 THEN 'alex ' || lower(c_mktsegment) END AS e_name,
  CASE WHEN (c_custkey // 7) % 4 = 2 THEN 'fixed' || CAST(c_custkey AS STRING) || '@example.net' END AS e_email,
  CASE WHEN (c_custkey // 7) % 4 = 3 THEN '(212) 555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS e_phone
  FROM customer WHERE c_custkey % 7 = 0),
m AS (SELECT p.* EXCLUDE (sap_id, contact_name, contact_email, contact_phone), p.sap_id AS o_sap, p.contact_name AS o_name, p.contact_email AS o_email,
  p.contact_phone AS o_phone,
  coalesce(nullif(e_sap, ''), p.sap_id) AS sap_id, coalesce(nullif(e_name, ''), p.contact_name) AS contact_name,
  coalesce(nullif(e_email, ''), p.contact_email) AS contact_email,
  coalesce(nullif(e_phone, ''), p.contact_phone) AS contact_phone
  FROM pending p LEFT JOIN corr c ON p.email_id = c.email_id)
"""
CORRECTED_DECISIONS = CORRECTED.rstrip("\n") + ",\n" + decided("m")

SUBJECT = "'More details needed for your account update request'"


def followup_body(lines: str) -> str:
    first = f"coalesce(nullif(regexp_extract({strip('contact_name')}, '^([^\\s\\x0b\\x1c-\\x1f]+)', 1), ''), 'there')"
    account = "coalesce(nullif(normalized_sap_id, ''), nullif(sap_id, ''), '[your account]')"
    nl = "chr(10)"
    return (f"'Hello ' || {first} || ',' || {nl} || {nl} || "
            f"'Thanks for asking us to update the contact details of account ' || {account} || '.' || {nl} || "
            f"'Before we can make the change, please check the following:' || {nl} || {nl} || "
            f"{lines} || {nl} || {nl} || "
            f"'You can reply to this message with the details laid out like this:' || {nl} || {nl} || "
            f"'SAP Account ID: SAP004711' || {nl} || 'Contact Name: Robin Vale' || {nl} || "
            f"'Contact Email: robin.vale@mail.example' || {nl} || 'Contact Phone: (303) 555-0188' || {nl} || {nl} || "
            f"'We will finish the update as soon as we have them.' || {nl} || {nl} || "
            f"'Kind regards,' || {nl} || 'Customer Service'")


ISSUE_LINES = "array_to_string(list_transform(issues, lambda i: '  - ' || i.field || ': ' || i.error), chr(10))"


def _issues_long() -> str:
    parts = []
    fields = [("sap", "SAP ID"), ("name", "Contact Name"), ("email", "Email"), ("phone", "Phone")]
    for k, (p, lab) in enumerate(fields):
        before = " + ".join(f"CAST(NOT {q}_valid AS BIGINT)" for q, _ in fields[:k]) or "0"
        parts.append(f"SELECT email_id, CAST({before} + 1 AS BIGINT) AS position, '{lab}' AS field, "
                     f"{p}_code AS code, {p}_error AS error FROM iv WHERE NOT {p}_valid")
    return (f"WITH {FX_FIELDS},\n" + rules_ctes("fx_fields", "iv", RAW, REVIEWER)
            + "\n" + " UNION ALL ".join(parts))


def _single(p: str, col: str, norm: bool) -> str:
    n = f", {p}_norm AS normalized" if norm else ""
    return (f"WITH {FX_FIELDS},\n" + rules_ctes("fx_fields", "v", RAW, PIPELINE)
            + f"\nSELECT email_id, {col} AS value, {p}_valid AS is_valid{n}, {p}_error AS error FROM v")


ADDR_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

ORACLE: dict[str, str] = {
    "emails_extracted": f"WITH {FX_FIELDS},\n{FX_EMAILS},\n{EXTRACTED}\n"
                        "SELECT email_id, sender, sap_id, contact_name, contact_email, contact_phone, "
                        "request_type, extraction_error FROM extracted_e",
    "extraction_outcome": f"WITH {FX_FIELDS},\n{FX_EMAILS},\n{EXTRACTED}\n"
                          "SELECT coalesce(extraction_error, 'ok') AS outcome, count(*) AS n_emails "
                          "FROM extracted_e GROUP BY 1",
    "variant_response_fields": f"""WITH {FX_FIELDS},\n{FX_EMAILS},
r0 AS (SELECT email_id, c_custkey, CAST(to_json({{'sap_id': sap_id, 'contact_name': contact_name,
          'contact_email': contact_email, 'contact_phone': contact_phone}}) AS VARCHAR) AS j FROM fx_emails),
r AS (SELECT email_id, CASE WHEN c_custkey % 23 = 0 THEN substring(j, 1, length(j) - 1) ELSE j END AS response FROM r0),
p AS (SELECT email_id, response, CASE WHEN response IS NULL THEN NULL ELSE json_valid(response) END AS ok FROM r)
SELECT email_id,
  json_extract_string(CASE WHEN ok THEN response END, '$.sap_id') AS sap_id,
  json_extract_string(CASE WHEN ok THEN response END, '$.contact_name') AS contact_name,
  json_extract_string(CASE WHEN ok THEN response END, '$.contact_email') AS contact_email,
  json_extract_string(CASE WHEN ok THEN response END, '$.contact_phone') AS contact_phone,
  coalesce(json_extract_string(CASE WHEN ok THEN response END, '$.request_type'), 'account_update') AS request_type,
  CASE WHEN response IS NULL THEN 'no_response' WHEN NOT ok THEN 'unparseable_response' END AS extraction_error
FROM p""",
    "extractor_fields": f"""WITH {FX_FIELDS},\n{FX_EMAILS},
r AS (SELECT email_id, body, contains(body, 'Cher') AS broken, contains(body, 'no form attached') AS late FROM fx_emails)
SELECT email_id,
  CASE WHEN NOT broken AND NOT late THEN nullif(regexp_extract(body, 'SAP[0-9]{{6}}'), '') END AS sap_id,
  CAST(NULL AS VARCHAR) AS contact_name,
  CASE WHEN NOT broken AND NOT late THEN nullif(regexp_extract(body, 'user[0-9]+@example\\.org'), '') END AS contact_email,
  CASE WHEN NOT broken AND NOT late THEN nullif(regexp_extract(body, '[0-9]{{3}}\\.555\\.[0-9]{{4}}'), '') END AS contact_phone,
  CASE WHEN NOT broken THEN 'account_update' END AS request_type,
  CASE WHEN broken THEN 'ValueError: unreadable body' WHEN late THEN 'model timeout' END AS extraction_error
FROM r""",
    "extraction_reused": f"""WITH {FX_FIELDS},\n{FX_EMAILS},
r AS (SELECT email_id, body, contains(body, 'Cher') AS broken, contains(body, 'no form attached') AS late FROM fx_emails)
SELECT email_id,
  CASE WHEN NOT broken AND NOT late THEN nullif(regexp_extract(body, 'SAP[0-9]{{6}}'), '') END AS sap_id,
  CAST(NULL AS VARCHAR) AS contact_name,
  CASE WHEN NOT broken AND NOT late THEN nullif(regexp_extract(body, 'user[0-9]+@example\\.org'), '') END AS contact_email,
  CASE WHEN NOT broken AND NOT late THEN nullif(regexp_extract(body, '[0-9]{{3}}\\.555\\.[0-9]{{4}}'), '') END AS contact_phone,
  CASE WHEN NOT broken THEN 'account_update' END AS request_type,
  CASE WHEN broken THEN 'ValueError: unreadable body' WHEN late THEN 'model timeout' END AS extraction_error,
  CASE WHEN broken OR late THEN 2 ELSE 1 END AS attempts
FROM r""",
    "action_state": f"""WITH {FX_ACTIONS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY created_at, action, actor_email) AS up,
             row_number() OVER (PARTITION BY email_id ORDER BY created_at DESC, action DESC, actor_email DESC) AS down
           FROM fx_actions WHERE email_id IS NOT NULL)
SELECT email_id, count(*) AS n_actions,
  max(created_at) FILTER (up = 1) AS first_action_at, max(action) FILTER (up = 1) AS first_action,
  max(actor_email) FILTER (up = 1) AS first_actor,
  max(created_at) FILTER (down = 1) AS last_action_at, max(action) FILTER (down = 1) AS last_action,
  max(actor_email) FILTER (down = 1) AS last_actor
FROM ranked GROUP BY email_id""",
    # Three commits of the log with an alert after each: 1, 3 and 5 are the log's.
    "alerts_since_mark": f"""WITH {FX_ACTIONS}
SELECT action, count(*) AS n_new, max(created_at) AS latest_at,
  CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END::BIGINT AS from_commit,
  CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 5 END::BIGINT AS to_commit
FROM fx_actions GROUP BY action, event_id % 3""",
    "null_flag_routing": DIRECT + """, f AS (SELECT email_id,
  CASE WHEN c_custkey % 5 <> 0 THEN sap_id_valid END AS sap_id_valid,
  CASE WHEN c_custkey % 5 <> 1 THEN name_valid END AS name_valid,
  CASE WHEN c_custkey % 5 <> 2 THEN email_valid END AS email_valid,
  CASE WHEN c_custkey % 5 <> 3 THEN phone_valid END AS phone_valid,
  CASE WHEN c_custkey % 5 <> 4 THEN sap_exists END AS sap_exists
  FROM q JOIN (SELECT email_id AS i, c_custkey FROM fx_fields) k ON q.email_id = k.i),
s AS (SELECT *, CASE WHEN sap_id_valid AND name_valid AND email_valid AND phone_valid AND sap_exists THEN 'PASS'
  WHEN sap_id_valid AND name_valid AND email_valid AND phone_valid AND NOT sap_exists THEN 'NEEDS_REVIEW'
  ELSE 'FAIL' END AS validation_status FROM f)
SELECT *, CASE validation_status WHEN 'PASS' THEN 'quick_approval' WHEN 'NEEDS_REVIEW' THEN 'detailed_review'
  ELSE 'rejected' END AS queue_type FROM s""",
    "validate_email": _single("email", "contact_email", False),
    "validate_phone": _single("phone", "contact_phone", True),
    "validate_account_id": _single("sap", "sap_id", True),
    "validate_name": _single("name", "contact_name", True),
    "validation_shaped": f"WITH {FX_FIELDS},\n" + rules_ctes("fx_fields", "v", RAW, PIPELINE) + """
SELECT email_id, sap_valid AS sap_id_valid, name_valid, email_valid, phone_valid,
  sap_norm AS normalized_sap_id, name_norm AS normalized_name, phone_norm AS normalized_phone,
  concat_ws('|', coalesce(sap_error, ''), coalesce(name_error, ''), coalesce(email_error, ''),
            coalesce(phone_error, '')) AS error_list
FROM v""",
    "issue_list_long": _issues_long(),
    "issue_summary": "SELECT field, code, count(*) AS n_issues FROM (" + _issues_long() + ") GROUP BY field, code",
    "directory_distinct": f"WITH {FX_FIELDS},\n{FX_EMAILS}\nSELECT DISTINCT upper(sap_id) AS sap_id, "
                          f"'ACTIVE' AS account_status, {AS_OF} AS last_updated FROM fx_emails "
                          "WHERE sap_id IS NOT NULL",
    "directory_exists_join": DIRECT + "SELECT email_id, normalized_sap_id, sap_exists FROM q",
    "directory_exists_filtered": DIRECT + "SELECT email_id, normalized_sap_id, sap_exists FROM q",
    "directory_exists_sqlfunc": DIRECT + "SELECT email_id, normalized_sap_id, sap_exists FROM q",
    "routed": DIRECT + "SELECT email_id, sap_id_valid, name_valid, email_valid, phone_valid, sap_exists, "
                       "validation_status, queue_type FROM q",
    "routing_summary": DIRECT + "SELECT validation_status, queue_type, count(*) AS \"count\" FROM q "
                                "GROUP BY 1, 2",
    "review_queue": DIRECT + f"SELECT {QUEUE_COLS}, {positional()} AS errors, queued_at FROM q",
    "review_errors_positional": DIRECT + f"SELECT email_id, {positional()} AS errors, "
                                         "CAST(5 AS BIGINT) AS n_slots FROM q",
    "review_errors_compact": DIRECT + f"SELECT email_id, {compact()} AS errors_compact, CAST("
                             + " + ".join(f"CAST(e{i} IS NOT NULL AS INT)" for i in range(1, 6))
                             + " AS BIGINT) AS n_errors FROM q",
    "review_record_sql": (f"WITH {FX_FIELDS},\n{FX_EMAILS},\n{FX_DIRECTORY},\n{EXTRACTED},\n"
                          f"{queue_ctes('extracted_e', 'q')}\n"
                          "SELECT email_id, sender, validation_status, queue_type, normalized_sap_id, "
                          "normalized_name, contact_email, normalized_phone, sap_exists FROM q"),
    "needs_review_view": DIRECT + f"""SELECT email_id, validation_status, queue_type, sap_id, contact_name,
  contact_email, contact_phone, normalized_sap_id, normalized_name, normalized_phone, {positional()} AS errors
FROM q WHERE queue_type IN ('detailed_review', 'rejected')""",
    "auto_approve_view": DIRECT + """SELECT email_id, validation_status, normalized_sap_id, normalized_name,
  normalized_phone AS contact_phone, contact_email, queued_at FROM q WHERE queue_type = 'quick_approval'""",
    "pending_items": EXTRACTED_Q + f"SELECT {PENDING_COLS} FROM pending",
    "pending_by_state": EXTRACTED_Q + f"SELECT {PENDING_COLS} FROM pending",
    "pending_search": EXTRACTED_Q + f"""SELECT {PENDING_COLS} FROM pending
WHERE contains(email_id, 'SAP0012') OR contains(sender, 'SAP0012') OR contains(sap_id, 'SAP0012')
   OR contains(normalized_sap_id, 'SAP0012')""",
    "pending_search_indexed": EXTRACTED_Q + f"""SELECT {PENDING_COLS} FROM pending
WHERE contains(email_id, 'SAP0012') OR contains(sender, 'SAP0012') OR contains(sap_id, 'SAP0012')
   OR contains(normalized_sap_id, 'SAP0012')""",
    "pending_like_indexed": EXTRACTED_Q + f"""SELECT {PENDING_COLS} FROM pending
WHERE email_id LIKE '%SAP00_2%1%' OR sender LIKE '%SAP00_2%1%' OR sap_id LIKE '%SAP00_2%1%'
   OR normalized_sap_id LIKE '%SAP00_2%1%'""",
    "pending_topk": EXTRACTED_Q + f"SELECT {PENDING_COLS} FROM pending "
                                  "ORDER BY validation_status DESC, email_id LIMIT 100",
    "kpi_counts": EXTRACTED_Q + """SELECT count(*) AS total,
  count(*) FILTER (WHERE validation_status = 'PASS') AS "pass",
  count(*) FILTER (WHERE validation_status = 'NEEDS_REVIEW') AS needs_review,
  count(*) FILTER (WHERE validation_status = 'FAIL') AS fail FROM pending""",
    "pending_with_body": EXTRACTED_Q + """SELECT p.email_id, p.validation_status, b.email_body FROM pending p
LEFT JOIN (SELECT email_id, min(body) AS email_body FROM fx_emails GROUP BY email_id) b ON p.email_id = b.email_id""",
    "status_labels": EXTRACTED_Q + """SELECT email_id, validation_status,
  coalesce(CASE validation_status WHEN 'PASS' THEN '✅' WHEN 'NEEDS_REVIEW' THEN '⚠️' WHEN 'FAIL' THEN '❌' END, '')
    || ' ' || validation_status AS status_display,
  CASE validation_status WHEN 'PASS' THEN 'Complete' WHEN 'NEEDS_REVIEW' THEN 'Needs Review' ELSE 'Incomplete' END AS badge_title,
  CASE validation_status WHEN 'PASS' THEN 'All fields extracted successfully'
       WHEN 'NEEDS_REVIEW' THEN 'SAP ID not found in database' ELSE 'Missing or invalid fields' END AS badge_detail
FROM pending""",
    "decisions": DECISIONS + """SELECT email_id, decision, all_valid, sap_value, name_value, email_value,
  phone_value, CAST(len(issues) AS BIGINT) AS n_issues FROM dec""",
    "approved_changes": DECISIONS + f"""SELECT email_id, final_sap_id AS sap_id, final_name AS contact_name,
  email_value AS contact_email, final_phone AS contact_phone, coalesce(email_body, '') AS source_email_body,
  {ACTOR} AS approved_by, {AS_OF} AS approved_at FROM dec WHERE decision = 'confirm'""",
    "confirm_actions": DECISIONS + f"""SELECT email_id, 'confirmed' AS action, {ACTOR} AS actor_email,
  CAST(NULL AS VARCHAR) AS old_values,
  CAST(to_json({{'sap_id': final_sap_id, 'contact_name': final_name, 'contact_email': email_value,
            'contact_phone': final_phone}}) AS VARCHAR) AS new_values,
  CAST(NULL AS VARCHAR) AS reason, {AS_OF} AS created_at FROM dec WHERE decision = 'confirm'""",
    "outgoing_emails": DECISIONS + f"""SELECT email_id, sender AS to_email, {SUBJECT} AS subject,
  {followup_body(ISSUE_LINES)} AS body, {ACTOR} AS created_by, {AS_OF} AS created_at, 'pending' AS status
FROM dec WHERE decision = 'followup'""",
    "followup_actions": DECISIONS + f"""SELECT email_id, 'followup_sent' AS action, {ACTOR} AS actor_email,
  CAST(to_json({{'missing_fields': issues}}) AS VARCHAR) AS old_values,
  CAST(to_json({{'followup_email': {{'to': sender, 'subject': {SUBJECT}}}}}) AS VARCHAR) AS new_values,
  'Missing or invalid fields' AS reason, {AS_OF} AS created_at FROM dec WHERE decision = 'followup'""",
    "batch_approve": DECISIONS + f"""SELECT email_id, final_sap_id AS sap_id, final_name AS contact_name,
  email_value AS contact_email, final_phone AS contact_phone, coalesce(email_body, '') AS source_email_body,
  {ACTOR} AS approved_by, {AS_OF} AS approved_at FROM dec
WHERE decision = 'confirm' AND validation_status = 'PASS'""",
    "merge_corrections": CORRECTED + """SELECT email_id, sap_id, contact_name, contact_email, contact_phone,
  concat_ws('|', CASE WHEN sap_id IS DISTINCT FROM o_sap THEN 'sap_id' END,
    CASE WHEN contact_name IS DISTINCT FROM o_name THEN 'contact_name' END,
    CASE WHEN contact_email IS DISTINCT FROM o_email THEN 'contact_email' END,
    CASE WHEN contact_phone IS DISTINCT FROM o_phone THEN 'contact_phone' END) AS changed_fields
FROM m""",
    "followup_from_errors": DIRECT + f"""SELECT email_id, sender AS to_email, {SUBJECT} AS subject,
  {followup_body("array_to_string(list_transform(list_filter([e1, e2, e3, e4, e5], lambda e: e IS NOT NULL), lambda e: '  - ' || e), chr(10))")} AS body
FROM q WHERE validation_status <> 'PASS'""",
    "audit_log_topk": f"""WITH {FX_ACTIONS}
SELECT email_id, coalesce(CASE action WHEN 'confirmed' THEN '✅ Confirmed'
  WHEN 'followup_sent' THEN '📤 Follow-up Sent' END, action) AS action, actor_email, created_at, reason
FROM fx_actions ORDER BY created_at DESC, event_id DESC LIMIT 100""",
    "followup_list": DECISIONS + f"""SELECT email_id, sender AS to_email, {SUBJECT} AS subject,
  {ACTOR} AS created_by, {AS_OF} AS created_at, 'pending' AS status
FROM dec WHERE decision = 'followup' ORDER BY created_at DESC, email_id DESC LIMIT 100""",
    "latest_followup": f"""WITH {FX_ACTIONS}
SELECT email_id, created_at, event_id, actor_email FROM fx_actions WHERE action = 'followup_sent'
QUALIFY row_number() OVER (PARTITION BY email_id ORDER BY created_at DESC, event_id DESC) = 1""",
    "turnaround": EXTRACTED_Q.rstrip("\n") + """,
fa AS (SELECT email_id, min(created_at) AS first_at, count(*) AS n_actions FROM fx_actions
       WHERE email_id IS NOT NULL GROUP BY email_id),
j AS (SELECT q.validation_status, fa.n_actions,
        (epoch_us(fa.first_at) - epoch_us(q.queued_at)) / 1e6 AS secs
      FROM q LEFT JOIN fa ON q.email_id = fa.email_id)
SELECT validation_status, count(*) AS n_items, count(secs) AS n_actioned,
  CAST(sum(n_actions) AS BIGINT) AS n_actions,
  round(avg(secs), 3) AS avg_seconds, round(min(secs), 3) AS min_seconds,
  round(max(secs), 3) AS max_seconds, round(quantile_disc(secs, 0.5), 3) AS p50_seconds
FROM j GROUP BY validation_status""",
    "turnaround_quantiles": EXTRACTED_Q.rstrip("\n") + """,
fa AS (SELECT email_id, min(created_at) AS first_at, count(*) AS n_actions FROM fx_actions
       WHERE email_id IS NOT NULL GROUP BY email_id),
j AS (SELECT q.validation_status, fa.n_actions,
        (epoch_us(fa.first_at) - epoch_us(q.queued_at)) / 1e6 AS secs
      FROM q LEFT JOIN fa ON q.email_id = fa.email_id)
SELECT validation_status, count(*) AS n_items, count(secs) AS n_actioned,
  CAST(sum(n_actions) AS BIGINT) AS n_actions,
  round(avg(secs), 3) AS avg_seconds, round(min(secs), 3) AS min_seconds,
  round(max(secs), 3) AS max_seconds, round(quantile_disc(secs, 0.5), 3) AS p50_seconds,
  round(quantile_disc(secs, 0.9), 3) AS p90_seconds, round(quantile_disc(secs, 0.99), 3) AS p99_seconds
FROM j GROUP BY validation_status""",
    "turnaround_by_actor": EXTRACTED_Q.rstrip("\n") + """,
fa AS (SELECT email_id, min(created_at) AS first_at, count(*) AS n_actions FROM fx_actions
       WHERE email_id IS NOT NULL GROUP BY email_id),
fx1 AS (SELECT email_id, actor_email AS first_actor FROM fx_actions WHERE email_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY email_id ORDER BY created_at, event_id) = 1),
j AS (SELECT q.validation_status, fx1.first_actor, fa.n_actions,
        (epoch_us(fa.first_at) - epoch_us(q.queued_at)) / 1e6 AS secs
      FROM q LEFT JOIN fa ON q.email_id = fa.email_id LEFT JOIN fx1 ON q.email_id = fx1.email_id)
SELECT validation_status, first_actor, count(*) AS n_items, count(secs) AS n_actioned,
  CAST(sum(n_actions) AS BIGINT) AS n_actions,
  round(avg(secs), 3) AS avg_seconds, round(min(secs), 3) AS min_seconds,
  round(max(secs), 3) AS max_seconds, round(quantile_disc(secs, 0.5), 3) AS p50_seconds
FROM j GROUP BY validation_status, first_actor""",
    "new_since": f"""WITH {FX_ACTIONS}
SELECT action, count(*) AS n_new, max(created_at) AS latest_at FROM fx_actions
WHERE created_at > TIMESTAMP '2024-01-15 00:00:00' GROUP BY action""",
    "document_contacts": f"""SELECT doc_id, CAST(len(a) AS BIGINT) AS n_addresses,
  array_to_string(list_sort(list_distinct(a)), ';') AS addresses,
  CAST(len(list_filter(a, lambda x: regexp_full_match({strip('x')}, '{EMAIL_RE}'))) AS BIGINT) AS n_valid
FROM (SELECT doc_id, regexp_extract_all(text, '{ADDR_RE}') AS a FROM documents) WHERE len(a) > 0""",
}

APPROVED_COLS = f"""email_id, final_sap_id AS sap_id, final_name AS contact_name,
  email_value AS contact_email, final_phone AS contact_phone, coalesce(email_body, '') AS source_email_body,
  {ACTOR} AS approved_by, {AS_OF} AS approved_at"""
OUTGOING_COLS = (f"email_id, sender AS to_email, {SUBJECT} AS subject, {followup_body(ISSUE_LINES)} AS body, "
                 f"{ACTOR} AS created_by, {AS_OF} AS created_at, 'pending' AS status")
EXTRACTED_FULL = (f"WITH {FX_FIELDS},\n{FX_EMAILS},\n{FX_DIRECTORY},\n{EXTRACTED},\n"
                  f"{queue_ctes('extracted_e', 'q')}\n")
QUEUE_OUT = EXTRACTED_FULL + f"SELECT {QUEUE_COLS}, {positional()} AS errors, queued_at FROM q"


def actions_sql(dec: str) -> str:
    """Audit rows of both kinds over a decisions statement."""
    return dec + f"""SELECT email_id, 'confirmed' AS action, {ACTOR} AS actor_email, CAST(NULL AS VARCHAR) AS old_values,
  CAST(to_json({{'sap_id': final_sap_id, 'contact_name': final_name, 'contact_email': email_value,
            'contact_phone': final_phone}}) AS VARCHAR) AS new_values,
  CAST(NULL AS VARCHAR) AS reason, {AS_OF} AS created_at FROM dec WHERE decision = 'confirm'
UNION ALL
SELECT email_id, 'followup_sent', {ACTOR}, CAST(to_json({{'missing_fields': issues}}) AS VARCHAR),
  CAST(to_json({{'followup_email': {{'to': sender, 'subject': {SUBJECT}}}}}) AS VARCHAR),
  'Missing or invalid fields', {AS_OF} FROM dec WHERE decision = 'followup'"""


ORACLE |= {
    "variant_column_fields": ORACLE["variant_response_fields"].replace(
        "WHEN NOT ok THEN 'unparseable_response'", "WHEN NOT ok THEN 'no_response'"),
    "chosen_decisions": CHOSEN + f"SELECT email_id, decision, coalesce(chosen_actor, {ACTOR}) AS actor FROM chosen",
    "edited_followups": CHOSEN + f"""SELECT email_id, sender AS to_email, coalesce(chosen_subject, {SUBJECT}) AS subject,
  coalesce(chosen_body, {followup_body(ISSUE_LINES)}) AS body, coalesce(chosen_actor, {ACTOR}) AS created_by,
  {AS_OF} AS created_at, 'pending' AS status FROM chosen WHERE decision = 'followup'""",
    "corrected_approvals": CORRECTED_DECISIONS + f"SELECT {APPROVED_COLS} FROM dec WHERE decision = 'confirm'",
    "auto_approved": CORRECTED_DECISIONS + f"""SELECT {APPROVED_COLS} FROM dec
WHERE decision = 'confirm' AND validation_status = 'PASS'""",
    "auto_approved_actions": CORRECTED_DECISIONS + f"""SELECT email_id, 'auto_approved' AS action, {ACTOR} AS actor_email,
  CAST(NULL AS VARCHAR) AS old_values,
  CAST(to_json({{'sap_id': final_sap_id, 'contact_name': final_name, 'contact_email': email_value,
            'contact_phone': final_phone}}) AS VARCHAR) AS new_values,
  'Passed all checks' AS reason, {AS_OF} AS created_at FROM dec
WHERE decision = 'confirm' AND validation_status = 'PASS'""",
    "latest_followup_text": f"""WITH {FX_OUTGOING}
SELECT email_id, created_at, subject, body FROM fx_outgoing
QUALIFY row_number() OVER (PARTITION BY email_id
  ORDER BY created_at DESC, to_email DESC, subject DESC, body DESC) = 1""",
    "followup_list_timed": f"""WITH {FX_OUTGOING}
SELECT email_id, to_email, subject, created_by, created_at, status FROM fx_outgoing
ORDER BY created_at DESC, email_id DESC, subject DESC, created_by DESC LIMIT 100""",
    "review_record_packed": DIRECT + f"SELECT {QUEUE_COLS} FROM q",
    "sink_directory": ORACLE["directory_distinct"],
    "sink_review_queue": QUEUE_OUT,
    "sink_catalog_queue": QUEUE_OUT,
    "queue_as_of_run": QUEUE_OUT,
    "stream_resent": QUEUE_OUT,
    "stream_queue": QUEUE_OUT,
    "intake_counts": EXTRACTED_FULL + """SELECT measure, n FROM (
  SELECT 'rows' AS measure, count(*) AS n FROM q
  UNION ALL SELECT s, count(q.email_id) FROM (VALUES ('PASS'), ('NEEDS_REVIEW'), ('FAIL')) v(s)
  LEFT JOIN q ON q.validation_status = s GROUP BY s)""",
    "sink_approved_changes": ALL_DECISIONS + f"SELECT {APPROVED_COLS} FROM dec WHERE decision = 'confirm'",
    "sink_outgoing_emails": ALL_DECISIONS + f"SELECT {OUTGOING_COLS} FROM dec WHERE decision = 'followup'",
    "sink_review_actions": actions_sql(ALL_DECISIONS),
    "sink_audit_csv": f"""WITH {FX_ACTIONS}
SELECT email_id, coalesce(CASE action WHEN 'confirmed' THEN '✅ Confirmed'
  WHEN 'followup_sent' THEN '📤 Follow-up Sent' END, action) AS action, actor_email, created_at, reason FROM fx_actions""",
}
