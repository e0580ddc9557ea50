"""Personal data spans against a plain re-implementation with Python's ``re``."""
import hashlib
import re

from pyspark.sql import functions as F

from contactlane.llm import pii
from contactlane.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) \
                    or (kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)) \
                    or (kind == "phone" and 8 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


CASES = [
    None, "", "   \n", "no data at all", "é\U0001F600 a.b@c.org,x@y.co.uk; a@b@c.com a@b.com_x@c.org",
    "1.2.3.4 300.1.1.1 001.002.003.004 1.2.3.4.5.6.7.8 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
    "4451718024887799 27.65.93.188", "+1 (845) 555-3372 call +49 30 1234567 +1 23", "+" * 50 + "1" * 12,
    "card 4111111111111111 card 5500005555555559", "IBAN GB82 WEST 1234 5698 7654 32 end DE89370400440532013000",
    "my ssn is 123-45-6789, code 123-45-6789", "phone (212) 555-0147 or 212.555.0148, ref 212-555-0149",
    "x" * 5_000 + "@", "7" * 5_000, ("a@b.c " * 700) + "4111111111111111", "1 " * 2_000, "+1" + "(" * 3_000,
]


def frame(spark):
    rows = [(i, t, "clash") for i, t in enumerate(CASES)] + [(1, "", "clash"), (4, CASES[4], "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, pii_base string").drop("pii_base") \
        .withColumn("lang", F.lit("xx"))


def test_base_spans_equal_the_plain_patterns(spark):
    for r in pii.find_spans(frame(spark)).collect():
        got = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["pii_base"])
        assert got == base_spans(r["text"]), r["doc_id"]


def test_added_spans_are_confirmed_or_in_context(spark):
    found = {r["doc_id"]: [(s["kind"], (r["text"] or "")[s["start"]:s["end"]]) for s in r["pii_spans"]]
             for r in pii.find_spans(frame(spark)).collect()}
    assert ("card", "4451718024887799") in found[7]
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in found[11] and ("iban", "DE89370400440532013000") in found[11]
    assert ("ssn", "123-45-6789") in found[12]
    assert ("local_phone", "(212) 555-0147") in found[13]
    assert found[0] == found[1] == found[3] == []


def test_every_base_span_stays_and_kinds_are_ordered(spark):
    for r in pii.find_spans(frame(spark)).collect():
        spans = [(pii.KINDS.index(s["kind"]), s["start"]) for s in r["pii_spans"]]
        assert spans == sorted(spans)
        assert {tuple(b) for b in r["pii_base"]} <= {tuple(s) for s in r["pii_spans"]}


def test_redaction_leaves_no_base_span_and_clean_text_alone(spark):
    out = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark)).collect()}
    assert out[0] is None and out[1] == "" and out[3] == CASES[3]
    assert out[6].startswith("[CARD] 4111-1111-1111-1112")
    assert out[7] == "[CARD] [IP]"
    assert out[8] == "[PHONE] call [PHONE] +1 23"
    for i, text in out.items():
        assert not base_spans(text), i


def test_long_texts_take_linear_time(spark):
    import time

    n = 1_000_000
    junk = ["x" * n + "@", "7" * n, "1 " * (n // 2), "+1" + "(" * n, "a@b.c " * 5_000, "1.2.3.400 " * 5_000, "+" * n]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(junk)], "doc_id long, text string").repartition(4).cache()
    df.count()
    start = time.perf_counter()
    found = {r["doc_id"]: r["n"] for r in pii.find_spans(df).select("doc_id", F.size("pii_base").alias("n")).collect()}
    pii.redact(df).select(F.length("text")).collect()
    assert time.perf_counter() - start < 60
    assert found[4] == 5_000 and found[0] == found[1] == found[2] == found[3] == found[5] == 0


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = REGISTRY["op8_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [base.count(f"{k}:") for k in PATTERNS]
        assert set(base.split(",")) <= set(r["spans"].split(","))


def test_no_python_in_the_plan(spark):
    plan = REGISTRY["op8_pii"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.find_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_context_words_are_whole_words_and_can_lower(spark):
    near = "a" * 37
    rows = ["hotel 555-123-4567", "tel 555-123-4567", "TEL: 555-123-4567", "555-123-4567 recall", "555-123-4567 (call)",
            "ho" + "tel " + near + "555-123-4567", "tel " + near[:36] + "555-123-4567",
            "DE89370400440532013000", "serial DE89370400440532013000", "serial, bank DE89370400440532013000",
            "phone code 555-123-4567"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r["doc_id"]: [s["kind"] for s in r["pii_spans"]] for r in pii.find_spans(df).collect()}
    phone = ["local_phone"]
    assert found == {0: [], 1: phone, 2: phone, 3: [], 4: phone, 5: [], 6: phone, 7: ["iban"], 8: [], 9: ["iban"],
                     10: phone}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[0] == rows[0] and clean[1] == "tel [LOCAL_PHONE]" and clean[8] == rows[8]


def test_no_two_spans_of_added_kinds_overlap(spark):
    rows = ["account DE89 3704 0044 0532 0130 00 phone 370-400-4405",
            "bank GB82 WEST 1234 5698 7654 32, call 123-456-9876, ssn 123-45-6789 4111 1111 1111 1111",
            "iban card phone NO93 8601 1117 947 860 111 1794", "phone card 4111 1111 1111 1111 111 1111"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for r in pii.find_spans(df).collect():
        base = {tuple(s) for s in r["pii_base"]}
        added = [s for s in r["pii_spans"] if tuple(s) not in base]
        for i, a in enumerate(added):
            others = added[:i] + [s for s in r["pii_base"]]
            assert all(a["end"] <= b["start"] or b["end"] <= a["start"] for b in others), r["doc_id"]
