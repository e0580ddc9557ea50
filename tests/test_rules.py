"""Rule vectors (literal inputs incl. NULL, blanks, Unicode) with literal
results, properties of the rules, and the expected values of FIXTURES.md."""
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlane.operators import validate as V

# Literal expectations: (value, normalised value, error); valid means no error.
EXPECTED = {
    "email": [
        ('john@example.com', None, None),
        (' a@b.co ', None, None),
        ('a@b.com\n', None, None),
        ('a@-.com', None, None),
        ('a@b..com', None, None),
        (None, None, 'Email is empty'),
        ('', None, 'Email is empty'),
        ('  ', None, 'Email is empty'),
        ('a@b', None, 'Invalid email format: a@b'),
        ('a@b.c', None, 'Invalid email format: a@b.c'),
        ('a b@c.de', None, 'Invalid email format: a b@c.de'),
        ('é@x.com', None, 'Invalid email format: é@x.com'),
        ('x@y.museum1', None, 'Invalid email format: x@y.museum1'),
        ('@b.com', None, 'Invalid email format: @b.com'),
        ('\xa0a@b.co\u2003', None, None),
        ('a@b.co\x1c', None, None),
        ('A.B+c%d@EX-ample.ORG', None, None),
        ('a@b.com\nx@y.org', None, 'Invalid email format: a@b.com\nx@y.org'),
    ],
    "phone": [
        ('555-123-4567', '(555) 123-4567', None),
        ('+1 555-123-4567', '(555) 123-4567', None),
        ('1-555-123-4567', '(555) 123-4567', None),
        ('5551234567 x', '(555) 123-4567', None),
        ('5551234567 x9', None, 'Phone must have 10 digits, got 11'),
        ('21234567890', None, 'Phone must have 10 digits, got 11'),
        ('11234567890', None, 'Area code cannot start with 0 or 1'),
        ('055-123-4567', None, 'Area code cannot start with 0 or 1'),
        ('555-0002', None, 'Phone must have 10 digits, got 7'),
        ('abc', None, 'Phone must have 10 digits, got 0'),
        (None, None, 'Phone is empty'),
        ('', None, 'Phone is empty'),
        ('   ', None, 'Phone is empty'),
        ('٥٥٥١٢٣٤٥٦٧', '(٥٥٥) ١٢٣-٤٥٦٧', None),
        ('(212) 555 0100', '(212) 555-0100', None),
        ('1 (212) 555-0100 ext', '(212) 555-0100', None),
    ],
    "sap_id": [
        ('sap123456', 'SAP123456', None),
        (' SAP123456 ', 'SAP123456', None),
        ('SAP123456\n', 'SAP123456', None),
        ('SAP12345', None, 'Invalid SAP ID format (expected SAPXXXXXX): SAP12345'),
        ('SAP1234567', None, 'Invalid SAP ID format (expected SAPXXXXXX): SAP1234567'),
        ('SAP 123456', None, 'Invalid SAP ID format (expected SAPXXXXXX): SAP 123456'),
        ('SAP-123456', None, 'Invalid SAP ID format (expected SAPXXXXXX): SAP-123456'),
        (None, None, 'SAP ID is empty'),
        ('', None, 'SAP ID is empty'),
        ('\t', None, 'SAP ID is empty'),
        ('sap١٢٣٤٥٦', 'SAP١٢٣٤٥٦', None),
        ('xSAP123456', None, 'Invalid SAP ID format (expected SAPXXXXXX): xSAP123456'),
    ],
    "name": [
        ('john smith', 'John Smith', None),
        ("mary-jane o'brien", "Mary-Jane O'Brien", None),
        ('3rd party mcdonald', '3Rd Party Mcdonald', None),
        ('  JOHN  SMITH ', 'John  Smith', None),
        ('\tjo\ndoe\n', 'Jo\nDoe', None),
        ('x', None, 'Name too short'),
        ('single', None, 'Name must include first and last name'),
        (None, None, 'Name is empty'),
        ('', None, 'Name is empty'),
        ('   ', None, 'Name is empty'),
        ('ab', None, 'Name must include first and last name'),
        ('x1y z', 'X1Y Z', None),
        ('anna\xa0lee', 'Anna\xa0Lee', None),
        ('jo\x1cdoe', 'Jo\x1cDoe', None),
        ('éLODIE durand', 'Élodie Durand', None),
        ("o'neil mc-GRATH", "O'Neil Mc-Grath", None),
        ('a b c', 'A B C', None),
    ],
}


def run(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                               T.StructType([T.StructField("i", T.IntegerType()),
                                             T.StructField("v", T.StringType())]))
    fn = {"email": V.validate_email, "phone": V.validate_phone,
          "sap_id": V.validate_account_id, "name": V.validate_name}[rule]
    out = fn(df, "v").orderBy("i").collect()
    res = []
    for r in out:
        s = r["validation"]
        res.append((s["is_valid"], s["normalized"] if "normalized" in s else None, s["error"]))
    return res


@pytest.mark.parametrize("rule", list(EXPECTED))
def test_rules_on_literals(spark, rule):
    got = run(spark, rule, [v for v, _, _ in EXPECTED[rule]])
    for (value, normalized, error), g in zip(EXPECTED[rule], got):
        assert g == (error is None, normalized, error), (rule, value)


PHONES, IDS, NAMES, EMAILS = ([v for v, _, _ in EXPECTED[r]] for r in ("phone", "sap_id", "name", "email"))


def test_fixture_vectors(spark):
    got = dict(zip(PHONES, run(spark, "phone", PHONES)))
    assert got["555-123-4567"] == (True, "(555) 123-4567", None)
    assert got["+1 555-123-4567"][1] == "(555) 123-4567"
    assert got["5551234567 x9"] == (False, None, "Phone must have 10 digits, got 11")
    assert got["11234567890"] == (False, None, "Area code cannot start with 0 or 1")
    assert got["555-0002"] == (False, None, "Phone must have 10 digits, got 7")
    assert got["abc"] == (False, None, "Phone must have 10 digits, got 0")
    names = dict(zip(NAMES, run(spark, "name", NAMES)))
    assert names["mary-jane o'brien"][1] == "Mary-Jane O'Brien"
    assert names["3rd party mcdonald"][1] == "3Rd Party Mcdonald"
    assert names["  JOHN  SMITH "][1] == "John  Smith"
    assert names["\tjo\ndoe\n"][1] == "Jo\nDoe"
    assert names["x"][2] == "Name too short"
    assert names["single"][2] == "Name must include first and last name"
    ids = dict(zip(IDS, run(spark, "sap_id", IDS)))
    for ok in ("sap123456", " SAP123456 ", "SAP123456\n"):
        assert ids[ok] == (True, "SAP123456", None)
    emails = dict(zip(EMAILS, run(spark, "email", EMAILS)))
    assert emails[None] == (False, None, "Email is empty")
    assert emails["a@b"] == (False, None, "Invalid email format: a@b")


ALPHABET = string.ascii_letters + string.digits + " .@-_+()'\t\n" + "  \x1cé١"


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=24)), min_size=50, max_size=120))
def test_rules_property(spark, values):
    """Flag and error agree, blanks are empty, surrounding blanks don't matter,
    and a normalised value is valid and its own normal form."""
    for rule in ("email", "phone", "sap_id", "name"):
        got = run(spark, rule, values)
        padded = run(spark, rule, [v if v is None else f" \t{v}\n" for v in values])
        again = run(spark, rule, [n for _, n, _ in got])
        for v, (ok, normalized, error), (ok2, normalized2, _), (_, normalized3, _) in zip(values, got, padded, again):
            assert ok == (error is None) and (ok or normalized is None), (rule, v)
            if v is None or not v.strip():
                assert not ok and error.endswith("is empty"), (rule, v)
            assert (ok, normalized) == (ok2, normalized2), (rule, v)
            if rule != "email" and ok:
                assert normalized3 == normalized, (rule, v)


def test_flag_iff_no_error_and_idempotent_normalisation(spark):
    vals = NAMES + PHONES
    df = spark.createDataFrame([(v, v, v, v) for v in vals],
                               "sap_id string, contact_name string, contact_email string, contact_phone string")
    out = V.validate_fields(df)
    for flag, struct in (("sap_id_valid", "sap_validation"), ("name_valid", "name_validation"),
                         ("email_valid", "email_validation"), ("phone_valid", "phone_validation")):
        bad = out.where(F.col(flag) != F.col(f"{struct}.error").isNull()).count()
        assert bad == 0
    again = V.validate_fields(out.select(
        F.col("normalized_sap_id").alias("sap_id"), F.col("normalized_name").alias("contact_name"),
        F.lit("a@b.co").alias("contact_email"), F.col("normalized_phone").alias("contact_phone"))
        .where(F.col("sap_id").isNotNull() | F.col("contact_name").isNotNull()
               | F.col("contact_phone").isNotNull()))
    rows = again.collect()
    for r in rows:
        if r["sap_id"] is not None:
            assert r["normalized_sap_id"] == r["sap_id"]
        if r["contact_name"] is not None:
            assert r["normalized_name"] == r["contact_name"]
        if r["contact_phone"] is not None:
            assert r["normalized_phone"] == r["contact_phone"]


def test_issue_list_reviewer_messages(spark):
    df = spark.createDataFrame([("e1", None, "x", "bad", "555"), ("e2", "SAP123456", "jo doe", "a@b.co",
                                                                   "2125550100")],
                               "email_id string, sap_id string, contact_name string, contact_email string, "
                               "contact_phone string")
    rows = {r["email_id"]: r for r in V.with_issues(df).collect()}
    assert [(i["field"], i["error"]) for i in rows["e1"]["issues"]] == [
        ("SAP ID", "SAP ID is missing"), ("Contact Name", "Name too short"),
        ("Email", "Invalid email format"), ("Phone", "Phone must have 10 digits, got 3")]
    assert rows["e1"]["all_valid"] is False
    assert rows["e2"]["issues"] == [] and rows["e2"]["all_valid"] is True


def test_whitespace_set_is_pythons():
    from contactlane.functions.textops import PY_WHITESPACE

    assert set(PY_WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_and_title_match_python(spark):
    from contactlane.functions import textops as tx

    vals = ["　 a b  ", "\x1cx\x1f", "\xa0\xa0", " mary-jane o'brien ", "ǆemal ß straße",
            "İstanbul ıi", "ﬁne ﬂow", "ΣΊΣΥΦΟΣ ΌΣ", "abc def", "ABC  dEF", "3rd x1y", "", "\u0085z\u0085"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    rows = df.select("s", F.expr(tx.strip("s")).alias("st"), F.expr(tx.title_case("s")).alias("t"),
                     F.expr(tx.first_word("s")).alias("w")).collect()
    for r in rows:
        assert r.st == r.s.strip(), repr(r.s)
        assert r.t == r.s.title(), repr(r.s)
        assert r.w == (r.s.split()[0] if r.s.split() else None), repr(r.s)
