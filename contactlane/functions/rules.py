"""Declarative field rules compiled to Spark SQL expressions.

A rule has named helper values (e.g. the stripped text, the phone digits),
an ordered list of checks over them -- each check that holds fails the field
with an error code, the first one wins -- and a normaliser for valid values.
Error text comes from a message catalogue keyed by code, so one rule set
serves both the intake pipeline and the reviewer screens, whose wording
differs.

Rules compile two ways from the same definition:

* ``inline_*``: one SQL expression per result, helpers substituted -- the
  bodies of the registered SQL functions;
* staged columns (see ``operators.validate``): helpers, then the error code,
  then the result struct, each a projection of its own so no helper is
  evaluated twice and generated code stays small.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from . import textops as tx
from .sqltext import fill, format_message, sql_string

# ---------------------------------------------------------------------------
# These must equal the reference's for results to match.
# Account ids are the prefix followed by exactly this many digits.
ACCOUNT_PREFIX = "SAP"
ACCOUNT_DIGITS = 6
# E-mail format (matched against the stripped value, whole string).
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Phone: 10 digits after dropping a leading country code 1 from 11 digits;
# the area code must not start with 0 or 1; normalised as (AAA) BBB-CCCC.
PHONE_DIGITS = 10
# Messages of the intake pipeline, by error code.
PIPELINE_MESSAGES: Mapping[str, str] = {
    "sap_id.empty": "SAP ID is empty",
    "sap_id.format": "Invalid SAP ID format (expected SAPXXXXXX): {value}",
    "name.empty": "Name is empty",
    "name.short": "Name too short",
    "name.parts": "Name must include first and last name",
    "email.empty": "Email is empty",
    "email.format": "Invalid email format: {value}",
    "phone.empty": "Phone is empty",
    "phone.length": "Phone must have 10 digits, got {n}",
    "phone.area": "Area code cannot start with 0 or 1",
    "sap_id.unknown": "SAP ID not found in database",
}
# Messages shown to reviewers (used for issue lists and follow-up texts).
REVIEWER_MESSAGES: Mapping[str, str] = {
    "sap_id.empty": "SAP ID is missing",
    "sap_id.format": "Invalid SAP ID format (expected SAPXXXXXX)",
    "name.empty": "Contact name is missing",
    "name.short": "Name too short",
    "name.parts": "Name must include first and last name",
    "email.empty": "Email is empty",
    "email.format": "Invalid email format",
    "phone.empty": "Phone number is missing",
    "phone.length": "Phone must have 10 digits, got {n}",
    "phone.area": "Area code cannot start with 0 or 1",
    "sap_id.unknown": "SAP ID not found in database",
}
# Field labels of the issue list, in issue order.
ISSUE_FIELDS = (("sap_id", "SAP ID"), ("name", "Contact Name"),
                ("email", "Email"), ("phone", "Phone"))
# ---------------------------------------------------------------------------

VALIDATION_TYPE = "STRUCT<is_valid: BOOLEAN, normalized: STRING, error: STRING>"
EMAIL_VALIDATION_TYPE = "STRUCT<is_valid: BOOLEAN, error: STRING>"


@dataclass(frozen=True)
class Check:
    """Fail with ``code`` when ``condition`` holds; ``args`` feed the message.

    ``condition`` and ``args`` are SQL templates over ``<<x>>`` (the input)
    and the rule's helper names (``<<clean>>``, ...).
    """

    condition: str
    code: str
    args: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FieldRule:
    name: str
    helpers: tuple[tuple[str, str], ...]   # (name, SQL template), in order
    checks: tuple[Check, ...]
    normalize: str | None                  # SQL template, or no normalised value

    # -- rendering ------------------------------------------------------------
    def bindings(self, x: str, helper_sql: Mapping[str, str] | None = None) -> dict[str, str]:
        """Template bindings: ``x`` plus each helper, either given (column
        references of a staged plan) or inlined from its template."""
        env = {"x": x}
        for name, template in self.helpers:
            env[name] = helper_sql[name] if helper_sql else f"({fill(template, env)})"
        return env

    def code_sql(self, env: Mapping[str, str]) -> str:
        """Error code of the first failing check, NULL when valid."""
        whens = " ".join(f"WHEN {fill(c.condition, env)} THEN {sql_string(c.code)}"
                         for c in self.checks)
        return f"CASE {whens} END"

    def error_sql(self, code: str, env: Mapping[str, str],
                  messages: Mapping[str, str]) -> str:
        """Message for an error code expression ``code``."""
        whens = " ".join(
            f"WHEN {sql_string(c.code)} THEN "
            f"{format_message(messages[c.code], {k: fill(v, env) for k, v in c.args.items()})}"
            for c in self.checks)
        return f"CASE {code} {whens} END"

    def normalized_sql(self, code: str, env: Mapping[str, str]) -> str:
        if self.normalize is None:
            return "CAST(NULL AS STRING)"
        return f"CASE WHEN {code} IS NULL THEN {fill(self.normalize, env)} END"

    def result_sql(self, code: str, env: Mapping[str, str],
                   messages: Mapping[str, str]) -> str:
        """The validation struct from an error code expression."""
        fields = [f"'is_valid', ({code} IS NULL)"]
        if self.normalize is not None:
            fields.append(f"'normalized', {self.normalized_sql(code, env)}")
        fields.append(f"'error', {self.error_sql(code, env, messages)}")
        return f"named_struct({', '.join(fields)})"

    # -- single-expression forms (SQL function bodies) ------------------------
    def inline_struct(self, x: str, messages: Mapping[str, str] = PIPELINE_MESSAGES) -> str:
        env = self.bindings(x)
        return self.result_sql(f"({self.code_sql(env)})", env, messages)

    def inline_valid(self, x: str) -> str:
        return f"(({self.code_sql(self.bindings(x))}) IS NULL)"


# Blank: NULL, or nothing left after stripping (tested on the stripped helper
# where the rule has one, so the text is stripped once).
_BLANK = "(<<x>> IS NULL OR " + tx.is_blank_text("<<x>>") + ")"
_BLANK_CLEAN = "(<<x>> IS NULL OR <<clean>> = '')"

EMAIL = FieldRule(
    "email",
    helpers=(("clean", tx.strip("<<x>>")),),
    checks=(Check(_BLANK_CLEAN, "email.empty"),
            Check("NOT (<<clean>> RLIKE " + sql_string(EMAIL_PATTERN[:-1] + r"\z") + ")",
                  "email.format", {"value": "<<x>>"})),
    normalize=None)

ACCOUNT_ID = FieldRule(
    "sap_id",
    helpers=(("clean", "upper(" + tx.strip("<<x>>") + ")"),),
    checks=(Check(_BLANK_CLEAN, "sap_id.empty"),
            Check("NOT (<<clean>> RLIKE " + sql_string(
                "(?U)^" + ACCOUNT_PREFIX + r"\d{" + str(ACCOUNT_DIGITS) + r"}\z") + ")",
                "sap_id.format", {"value": "<<x>>"})),
    normalize="<<clean>>")

PHONE = FieldRule(
    "phone",
    helpers=(("all_digits", tx.digits("<<x>>")),
             ("digits", f"CASE WHEN length(<<all_digits>>) = {PHONE_DIGITS + 1} "
                        f"AND left(<<all_digits>>, 1) = '1' THEN substring(<<all_digits>>, 2) "
                        f"ELSE <<all_digits>> END")),
    checks=(Check(_BLANK, "phone.empty"),
            Check(f"length(<<digits>>) <> {PHONE_DIGITS}", "phone.length",
                  {"n": "length(<<digits>>)"}),
            Check("left(<<digits>>, 1) IN ('0', '1')", "phone.area")),
    normalize="concat('(', substring(<<digits>>, 1, 3), ') ', substring(<<digits>>, 4, 3), "
              "'-', substring(<<digits>>, 7, 4))")

NAME = FieldRule(
    "name",
    helpers=(("clean", tx.strip("<<x>>")),),
    checks=(Check(_BLANK_CLEAN, "name.empty"),
            Check("length(<<clean>>) < 2", "name.short"),
            Check("NOT " + tx.has_whitespace("<<clean>>"), "name.parts")),
    normalize=tx.title_case("<<clean>>"))

RULES: Mapping[str, FieldRule] = {"sap_id": ACCOUNT_ID, "name": NAME,
                                  "email": EMAIL, "phone": PHONE}
