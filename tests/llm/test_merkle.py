"""The manifest against a plain tree in Python, and its own proofs."""
import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from contactlane.llm import merkle
from contactlane.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = [*[row[f] for f in FIELDS[:-1]], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_above(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([sha("".join(own[i:i + 3])) for i in range(0, len(own), 3)])
    return levels


def steps(levels, at):
    """(place in its run, siblings) from a leaf up."""
    out = []
    for own in levels[:-1]:
        run = own[at - at % 3:at - at % 3 + 3]
        out.append((at % 3, run[:at % 3] + run[at % 3 + 1:]))
        at //= 3
    return out


def folded(node, path):
    for digit, siblings in path:
        node = sha("".join(siblings[:digit] + [node] + siblings[digit:]))
    return node


def brute(rows):
    """Multiset of results of the query, as sorted tuples."""
    by_source = defaultdict(list)
    for r in rows:
        gone = zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 2 == 0
        text = r["text"]
        now = text.replace("\n", "") if gone and text is not None else text
        by_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, text), leaf_of(r, now),
                                       r["doc_id"]))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_above([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    over = levels_above([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        above = steps(over, k)
        for i, (_, _, leaf, now, doc_id) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            path = steps(trees[s], i) + above
            proof = sha("".join(x for _, siblings in path for x in siblings))
            back = folded(now, path)
            out.append((str(doc_id), leaf, trees[s][-1][0], over[-1][0], proof, back, back == over[-1][0]))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"],
                   r["verified"]) for r in df.collect())


def test_query_equals_plain_tree(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert result(REGISTRY["op13_merkle"](spark, SF)) == brute(rows)


def query_of(df, levels):
    def digest(text):
        return merkle.digest_of([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    now = F.when(crc % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = merkle.manifest(df, digest(F.col("text")), digest(now), levels=levels)
    return proofs.select("doc_id", "leaf", "subroot", "root", "folded_root", "verified",
                         F.sha2(merkle.siblings_text(F.col("proof")), 256).alias("proof_sha256"))


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_edge_rows(spark, levels):
    schema = "doc_id long, text string, lang string, source string, n_chars long, leaf string, path double"
    rows = [(i, f"a\nb {i}", "de", "hot", 5) for i in range(40)]
    rows += [(7, "equal\n", "de", "hot", 6)] * 12 + [(None, "no id\n", None, "hot", None)] * 3 + [(3, None, None, "hot", 0)]
    rows += [(100, "", "en", None, 0), (101, "\n\n", "en", None, 2), (102, "alone", "en", "", 5),
             (103, "é漢\U0001F600" * 4000 + "\n", "x", "Ä", 12000), (104, "z", None, "z", 1), (105, "￿", "q", "￿", 1),
             (106, "\U0001F600", "q", "\U0001F600", 1)]
    df = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], schema).repartition(5)
    assert result(query_of(df, levels)) == brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r))
                                                  for r in rows])


def test_proofs_alone_lead_to_the_root(spark):
    df = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"))
    leaf = merkle.digest_of([F.col("doc_id")])
    rows = merkle.manifest(df, leaf, leaf, levels=2).collect()
    assert len(rows) == 30 and all(r["verified"] for r in rows)
    for r in rows:
        assert merkle.fold(r["leaf"], r["proof"]) == r["root"] == r["subroot"]
    one = merkle.manifest(df.limit(1), leaf, F.lit("0" * 64)).first()
    assert one["root"] == one["leaf"] and one["proof"] == [] and not one["verified"]
    assert merkle.manifest(df.limit(0), leaf, leaf).count() == 0
