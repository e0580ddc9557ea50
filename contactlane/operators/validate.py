"""Field validation over whole DataFrames.

Rules are applied in three projections -- helper values, error codes, result
columns -- so each regex runs once per row and the generated code stays
small. All of it is built-in expressions; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.sqltext import fill, ident

# Column holding each field, by rule name.
DEFAULT_FIELDS = {"sap_id": "sap_id", "name": "contact_name",
                  "email": "contact_email", "phone": "contact_phone"}
_STRUCT_COLUMN = {"sap_id": "sap_validation", "name": "name_validation",
                  "email": "email_validation", "phone": "phone_validation"}


class Staged:
    """Helper and error-code columns of several rules over one DataFrame."""

    def __init__(self, df: DataFrame, fields: Mapping[str, str], tag: str = "v"):
        self.rules = {n: R.RULES[n] for n in fields}
        self.envs: dict[str, dict[str, str]] = {}
        self.temp: list[str] = []
        helper_cols: dict[str, Column] = {}
        depth = max((len(r.helpers) for r in self.rules.values()), default=0)
        for n, rule in self.rules.items():
            self.envs[n] = {"x": ident(fields[n])}
        for level in range(depth):  # helpers may use earlier helpers
            helper_cols = {}
            for n, rule in self.rules.items():
                if level < len(rule.helpers):
                    h, template = rule.helpers[level]
                    name = f"_{tag}_{n}_{h}"
                    helper_cols[name] = F.expr(fill(template, self.envs[n]))
                    self.envs[n][h] = ident(name)
                    self.temp.append(name)
            df = df.withColumns(helper_cols)
        codes = {}
        for n, rule in self.rules.items():
            name = f"_{tag}_{n}_code"
            codes[name] = F.expr(rule.code_sql(self.envs[n]))
            self.temp.append(name)
        self.codes = {n: ident(f"_{tag}_{n}_code") for n in self.rules}
        self.df = df.withColumns(codes)

    def struct(self, n: str, messages: Mapping[str, str] = R.PIPELINE_MESSAGES) -> Column:
        return F.expr(self.rules[n].result_sql(self.codes[n], self.envs[n], messages))

    def valid(self, n: str) -> Column:
        return F.expr(f"{self.codes[n]} IS NULL")

    def normalized(self, n: str) -> Column:
        return F.expr(self.rules[n].normalized_sql(self.codes[n], self.envs[n]))

    def code(self, n: str) -> Column:
        return F.expr(self.codes[n])

    def error(self, n: str, messages: Mapping[str, str]) -> Column:
        return F.expr(self.rules[n].error_sql(self.codes[n], self.envs[n], messages))

    def finish(self, out: DataFrame) -> DataFrame:
        return out.drop(*self.temp)


def _one(df: DataFrame, rule: str, column: str, out: str) -> DataFrame:
    st = Staged(df, {rule: column}, tag=out)
    return st.finish(st.df.withColumn(out, st.struct(rule)))


def validate_email(df: DataFrame, column: str, out: str = "validation") -> DataFrame:
    return _one(df, "email", column, out)


def validate_phone(df: DataFrame, column: str, out: str = "validation") -> DataFrame:
    return _one(df, "phone", column, out)


def validate_account_id(df: DataFrame, column: str, out: str = "validation") -> DataFrame:
    return _one(df, "sap_id", column, out)


def validate_name(df: DataFrame, column: str, out: str = "validation") -> DataFrame:
    return _one(df, "name", column, out)


def validate_fields(df: DataFrame, fields: Mapping[str, str] = DEFAULT_FIELDS,
                    messages: Mapping[str, str] = R.PIPELINE_MESSAGES) -> DataFrame:
    """All columns of ``df`` plus the four validation structs, the four flags,
    three normalised values and ``error_list`` (one slot per field, NULL when
    the field is fine)."""
    st = Staged(df, fields)
    out = st.df.withColumns({_STRUCT_COLUMN[n]: st.struct(n, messages) for n in fields})
    out = out.withColumns({
        "sap_id_valid": F.col("sap_validation.is_valid"),
        "name_valid": F.col("name_validation.is_valid"),
        "email_valid": F.col("email_validation.is_valid"),
        "phone_valid": F.col("phone_validation.is_valid"),
        "normalized_sap_id": F.col("sap_validation.normalized"),
        "normalized_name": F.col("name_validation.normalized"),
        "normalized_phone": F.col("phone_validation.normalized"),
        "error_list": F.array(F.col("sap_validation.error"), F.col("name_validation.error"),
                              F.col("email_validation.error"), F.col("phone_validation.error")),
    })
    return st.finish(out)


def with_issues(df: DataFrame, fields: Mapping[str, str] = DEFAULT_FIELDS,
                messages: Mapping[str, str] = R.REVIEWER_MESSAGES,
                issues: str = "issues", all_valid: str = "all_valid",
                normalized: Mapping[str, str] | None = None) -> DataFrame:
    """V5: ``issues`` = ARRAY<STRUCT<field, code, error>> of failing fields in
    the order account id, name, e-mail, phone; ``all_valid`` = AND of the
    four. ``normalized`` maps rule name -> output column for normalised values."""
    st = Staged(df, fields, tag="i")
    items = [F.when(~st.valid(n), F.struct(F.lit(label).alias("field"),
                                           st.code(n).alias("code"),
                                           st.error(n, messages).alias("error")))
             for n, label in R.ISSUE_FIELDS]
    valid = st.valid("sap_id")
    for n in ("name", "email", "phone"):
        valid = valid & st.valid(n)
    cols = {issues: F.array_compact(F.array(*items)), all_valid: valid}
    for n, out in (normalized or {}).items():
        cols[out] = st.normalized(n)
    return st.finish(st.df.withColumns(cols))


def issues_long(df: DataFrame, key: str = "email_id", issues: str = "issues") -> DataFrame:
    """One row per issue: key, position (1-based), field, code, error."""
    return (df.select(key, F.posexplode(issues).alias("pos", "issue"))
            .select(key, (F.col("pos") + 1).cast("long").alias("position"),
                    F.col("issue.field").alias("field"), F.col("issue.code").alias("code"),
                    F.col("issue.error").alias("error")))

