"""The trigram index gives what a scan gives, and reads the wanted buckets and parts only."""
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from contactlane.operators import queue as Q
from contactlane.plans import queries as QS
from contactlane.plans import review_runs as RR
from contactlane.plans import search_index as S
from contactlane.sources import fixtures as fx
from contactlane.sources import runs as R
from contactlane.sources import schemas


def put_queue(store, rows):
    run = store.begin("intake")
    have = [c for c in rows.columns]
    run.write("review_queue", rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                                 for f in schemas.REVIEW_QUEUE if f.name not in have]))
    return run.commit()


def rows_of(df):
    return sorted(map(tuple, df.select(*Q.SEARCH_COLUMNS).collect()), key=str)


def scan(store, query, mode="contains"):
    return store.read("review_queue").where(Q.search_filter(query, mode))


@pytest.fixture(scope="module")
def store(spark):
    """A queue with ids, hot and NULL values, in parts of 40 rows."""
    import tempfile

    rnd = random.Random(7)
    rows = [(f"EMAIL-{i:05d}", f"s{rnd.randint(0, 99)}@mail{i % 7}.example.com", f"SAP{rnd.randint(0, 10**6):06d}",
             rnd.choice([None, f"SAP{rnd.randint(0, 10**6):06d}"])) for i in range(300)]
    rows += [("EMAIL-00007", "same@x", "a%b_c\\d", None)] * 40 + [(None, "null@id", "Ünïcode\U0001F600x", "")] * 5
    rows += [("x", "", "ab", None), ("last", "50%_off", None, "abcabcabc")]
    own = R.RunStore(spark, tempfile.mkdtemp(prefix="contactlane-search-"), S.TABLES)
    put_queue(own, spark.createDataFrame(rows, "email_id string, sender string, sap_id string, normalized_sap_id string")
              .repartition(3))
    assert S.build_index(own, part_rows=40) == 2 and S.build_index(own) is None
    return own


QUERIES = [("SAP12", "contains"), ("EMAIL-00007", "contains"), ("a%b_c\\d", "contains"), ("null@id", "contains"),
           ("ïcode\U0001F600", "contains"), ("50%_off", "contains"), ("abcabcabcabc", "contains"), ("nothing", "contains"),
           ("EMAIL", "contains"), ("ab", "contains"), ("sap1", "contains"), ("@mail3", "contains"),
           ("SAP_2%9", "like"), ("EMAIL-000_7", "like"), ("same%x", "like"), ("a\\%b\\_c", "like"), ("%", "like"),
           ("50\\%\\_off", "like"), ("s5%mail3", "like"), ("abc%abc%abc", "like"), ("_", "like")]


@pytest.mark.parametrize("query,mode", QUERIES)
def test_equals_a_scan(store, query, mode):
    assert rows_of(S.search(store, query, mode)) == rows_of(scan(store, query, mode))


def test_random_texts_equal_a_scan(store):
    rnd, texts = random.Random(3), [t for r in rows_of(store.read("review_queue")) for t in r if t and len(t) > 3]
    for _ in range(8):
        text = rnd.choice(texts)
        start = rnd.randrange(len(text) - 3)
        piece = text[start:start + rnd.randint(3, 7)]
        assert rows_of(S.search(store, piece)) == rows_of(scan(store, piece))


def test_reads_wanted_buckets_and_parts_only(store):
    found = S.candidates(store, "EMAIL-00123", "contains", store.last())
    plan = found._jdf.queryExecution().executedPlan().toString()
    buckets = {int(x) for x in re.search(r"PartitionFilters: \[.*?bucket#\d+ IN \(([\d,]+)\)", plan)[1].split(",")}
    assert buckets <= {zlib.crc32(g.encode()) % (S.BUCKETS_A_PART * 9) for g in S.query_grams("EMAIL-00123", "contains")}
    assert len(buckets) <= S.RAREST and re.search(r"PushedFilters: \[.*In\(gram, ", plan)
    hit = S.search(store, "EMAIL-00123")
    assert re.search(r"PartitionFilters: \[.*part#\d+ = \d+\)", hit._jdf.queryExecution().executedPlan().toString())
    assert store.read(S.ROWS).select("part").distinct().count() > 4 and hit.count() == 1
    # a text that every row has, or without three characters, is left to the scan
    assert S.candidates(store, "EMAIL", "contains", store.last()) is None
    assert S.candidates(store, "ab", "contains", store.last()) is None
    assert S.candidates(store, "a\\b", "like", store.last()) is None


def test_a_newer_queue_is_scanned_until_indexed(spark, tmpdir_path):
    own = R.RunStore(spark, tmpdir_path, S.TABLES)
    assert S.search(own, "EMAIL-1").count() == 0 and S.build_index(own) is None
    emails = fx.emails(spark, SF001)
    RR.run_intake(own, emails.limit(0), QS.directory(spark, SF001), QS.as_of())
    S.build_index(own)
    assert S.search(own, "EMAIL-00000012").count() == 0
    RR.run_intake(own, emails, QS.directory(spark, SF001), QS.as_of())
    assert S.candidates(own, "EMAIL-00000012", "contains", own.last()) is None
    assert S.search(own, "EMAIL-00000012").count() == 1
    S.build_index(own)
    assert S.candidates(own, "EMAIL-00000012", "contains", own.last()) is not None
    assert S.search(own, "EMAIL-00000012").count() == 1
    actions = fx.actions(spark, SF001)
    for query, mode in (("SAP0001", "contains"), ("SAP0_01", "like")):
        want = Q.pending_items(own.read("review_queue"), actions, query, mode)
        assert S.pending_search(own, actions, query, mode).collect() == want.collect()
        assert S.pending_search(own, actions, query, mode, limit=3).collect() == want.limit(3).collect()
