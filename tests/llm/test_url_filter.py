"""URL rules against a plain evaluation, mined rules against exhaustive counts."""
import itertools
import re

from pyspark.sql import functions as F

from contactlane.llm import url_filter as U
from contactlane.llm.queries import REGISTRY, URL_RULES

SF = "/root/testdata/sf0.01"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), raw), re.match(r"[^?#]*", rest[len(raw):])[0]


def explicit(host, path):
    best = None
    for verdict, h, p in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[1]):
                best = (verdict, h + p)
    return best


URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/",
        "https://a.b.example.com/en/?q=http://net/es/", "https://x.net/es/1", "https://xnet/es/1", "https://net/fr/",
        "http://ÀB.net/fr/É#f", "http://com", "http://com/", "http://example.com?x=/en/", "a://b://c/d",
        "http://x.org/fr/" + "a" * 100_000, "https://x.net/es/1"]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)], "page_id long, url string, tokens string")
    labels = spark.createDataFrame([], "doc_id long, bad boolean")
    rows = U.judge_urls(pages, labels, URL_RULES, 0.01, 0.5).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = split(r["url"])
        assert (r["host"], r["path"]) == (host, path), r["url"]
        want = explicit(host, path)
        assert r["rule"] == (want[1] if want else None)
        assert r["verdict"] == (want[0] if want else "allow")


def brute_rules(sets, min_support, min_confidence):
    """Every combination of tokens, counted; minimal ones that reach both bounds."""
    found = {}
    for size in range(1, 5):
        combos = {c for tokens, _ in sets for c in itertools.combinations(sorted(tokens), size)}
        for c in combos:
            has = [bad for tokens, bad in sets if set(c) <= tokens]
            if sum(has) >= min_support * len(sets) and sum(has) / len(has) >= min_confidence and sum(has):
                if not any(set(f) < set(c) for f in found):
                    found[c] = sum(has) / len(has)
    return found


def test_mined_rules_equal_exhaustive_counts(spark):
    sets = [({"a", "b"}, True), ({"a", "b", "c"}, True), ({"a", "c"}, False), ({"b", "c"}, False), ({"a"}, False),
            ({"d"}, True), ({"d", "c"}, True), ({"b"}, False), ({"a", "b", "d"}, True), (set(), False)]
    df = spark.createDataFrame([(sorted(t), b) for t, b in sets], "tokens array<string>, bad boolean")
    rules = {tuple(r["antecedent"]): r for r in U.mine_rules(df, 0.2, 0.8).collect()}
    want = brute_rules(sets, 0.2, 0.8)
    assert {k: round(r["confidence"], 9) for k, r in rules.items()} == {k: round(v, 9) for k, v in want.items()}
    assert all(r["key"] in k for k, r in rules.items())
    urls = spark.createDataFrame([("u1", ["a", "b", "x"]), ("u2", ["a"]), ("u3", ["d"]), ("u4", [])],
                                 "url string, tokens array<string>")
    hit = {r["url"]: r["matched"] for r in U.match_rules(urls, U.mine_rules(df, 0.2, 0.8)).collect()}
    assert hit == {"u1": 1, "u3": 1}


def test_labels_of_one_value_or_null(spark):
    for bad in (True, None):
        df = spark.createDataFrame([(["a"], bad)] * 3, "tokens array<string>, bad boolean")
        assert U.mine_rules(df, 0.5, 0.5).count() == (1 if bad else 0)


def test_query_covers_every_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    rows = {r["page_id"]: r for r in REGISTRY["op7_url_filter"](spark, SF).collect()}
    assert len(rows) == len(pages)
    for p in pages:
        host, path = split(p["url"])
        r, want = rows[p["page_id"]], explicit(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, want[1] if want else None)
        assert r["verdict"] == (want[0] if want else ("block" if r["matched"] else "allow"))


def test_no_python_in_the_plan(spark):
    out = REGISTRY["op7_url_filter"](spark, SF)
    assert out.where(F.col("verdict").isNull()).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_need_rows_and_hold_on_others(spark):
    """Hosts seen a few times are not learned by heart; a bad host's unseen pages are blocked."""
    urls = [(i, f"http://{'bad' if i % 4 == 0 else f'h{i % 50}'}.org/a/{i}/p.html") for i in range(400)]
    urls += [(1000 + i, f"http://rare{i}.org/a/{1000 + i}/p.html") for i in range(30)]
    labels = [(i, i % 4 == 0 and i % 40 != 0) for i in range(200)] + [(1000 + i, i < 15) for i in range(30)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    known = spark.createDataFrame(labels, "doc_id long, bad boolean")
    rows = {r["page_id"]: r for r in U.judge_urls(pages, known, (), 0.001, 0.5).collect()}
    assert {i for i, r in rows.items() if r["verdict"] == "block"} == set(range(0, 400, 4))
    few = U.judge_urls(pages, known.where("doc_id % 12 = 0 AND doc_id < 200"), (), 0.001, 0.5)
    assert few.where("verdict = 'block'").count() == 0


def test_hot_and_missing_urls_and_empty_pages(spark):
    schema = "page_id long, url string, host string, tokens string, matched string, confidence string"
    rows = [(i, None if i % 3 == 0 else "http://hot.org/7" if i % 3 == 1 else f"http://c{i}.org/9", "x", "x", "x", "x")
            for i in range(3000)]
    labels = spark.createDataFrame([(7, True), (9, False), (None, True)], "doc_id long, bad boolean")
    out = U.judge_urls(spark.createDataFrame(rows, schema), labels, (), 0.001, 0.5).collect()
    assert sorted(r["page_id"] for r in out) == list(range(3000))
    assert all((r["verdict"] == "block") == (r["url"] == "http://hot.org/7") for r in out)
    assert U.judge_urls(spark.createDataFrame([], schema), labels, (), 0.001, 0.5).count() == 0
