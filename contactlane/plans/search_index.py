"""Search of the review queue by a trigram index.

The index of a queue snapshot is three tables, written in one commit: the rows of
the pending list with a number each, in parts of bounded size; postings (trigram,
row, column) in buckets by trigram, ordered within their files; and the number
of postings of every trigram. A search text's trigrams must all occur in one
column of a hit, so its rarest ones are looked up in their buckets alone, their
postings intersected per row and column, and only the parts with candidates
are read, where the search condition itself decides. Results are those of a scan.

A scan is used where the index can't help: texts without three characters in a
row, trigrams that a large share of the rows has, and a queue that is newer than
its index.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import queue as Q
from ..sources import schemas, tables
from ..sources.runs import REVIEW_TABLES, Run, RunStore, RunTable, attempt, rewrites

ROWS, POSTINGS, GRAMS = "search_rows", "search_postings", "search_grams"
LONG, INT = T.LongType(), T.IntegerType()
SEARCH_TABLES = {
    ROWS: RunTable(T.StructType([schemas.REVIEW_QUEUE[c] for c in Q.PENDING_COLUMNS]
                                + [T.StructField("row_id", LONG), T.StructField("part", INT)]), append=False, by=("part",)),
    POSTINGS: RunTable(T.StructType([T.StructField("gram", T.StringType()), T.StructField("row_id", LONG),
                                     T.StructField("field", INT), T.StructField("bucket", INT)]),
                       append=False, by=("bucket",)),
    GRAMS: RunTable(T.StructType([T.StructField("gram", T.StringType()), T.StructField("n", LONG),
                                  T.StructField("bucket", INT)]), append=False, by=("bucket",)),
}
TABLES = REVIEW_TABLES | SEARCH_TABLES
# Positions and sizes in an index commit: the queue's commit, rows, buckets.
OF_QUEUE, N_ROWS, N_BUCKETS = "search:queue", "search:rows", "search:buckets"

GRAM = 3
PART_ROWS = 250_000      # rows in a part, about
BUCKETS_A_PART = 16
RAREST = 4               # trigrams looked up for a search
SCAN_SHARE = 0.2         # a trigram of more rows is no help
ROW_BITS = 33            # of monotonically_increasing_id: rows within a partition


def grams_of(text: Column) -> Column:
    """Distinct runs of three characters (empty for shorter texts and NULL)."""
    n = F.length(text)
    return F.when(n >= GRAM, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n - (GRAM - 1), F.lit(1))), lambda i: F.substring(text, i, GRAM)))).otherwise(
        F.array().cast("array<string>"))


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(buckets)).cast("int")


def literal_parts(query: str, mode: str) -> list[str] | None:
    """Texts that every match holds, in one column; ``None`` for a LIKE pattern whose
    escapes only the scan can judge."""
    if mode != "like":
        return [query]
    parts, i = [""], 0
    while i < len(query):
        c = query[i]
        if c == "\\":
            i += 1
            if i == len(query) or query[i] not in "%_\\":
                return None
            parts[-1] += query[i]
        elif c in "%_":
            parts.append("")
        else:
            parts[-1] += c
        i += 1
    return [p for p in parts if p]


def query_grams(query: str, mode: str) -> list[str]:
    """Trigrams every match has."""
    found = {p[i:i + GRAM] for p in literal_parts(query, mode) or [] for i in range(len(p) - GRAM + 1)}
    return sorted(found)


def build_index(store: RunStore, part_rows: int = PART_ROWS) -> int | None:
    """Index the committed queue: the commit that shows it; ``None`` if it is up to date."""
    def work(run: Run) -> int | None:
        of = last_queue(store, run.seen)
        if of == store.offset(OF_QUEUE, run.seen):
            return None
        queue = run.read("review_queue").select(*Q.PENDING_COLUMNS)
        n = queue.count()
        parts = max(1, -(-n // part_rows))
        buckets = BUCKETS_A_PART * parts
        # ordered by id, and rows of one id by their content, so that no id is one part
        placed = queue.repartitionByRange(parts, F.col("email_id"), F.xxhash64(*Q.PENDING_COLUMNS)).withColumn(
            "row_id", F.monotonically_increasing_id())
        run.write(ROWS, placed.withColumn("part", F.shiftright("row_id", ROW_BITS)))
        each = [F.struct(F.lit(i).alias("field"), grams_of(F.col(c)).alias("grams"))
                for i, c in enumerate(Q.SEARCH_COLUMNS)]
        found = run.own(ROWS).select("row_id", F.explode(F.array(*each)).alias("f")).select(
            "row_id", "f.field", F.explode("f.grams").alias("gram"))
        found = found.withColumn("bucket", bucket_of(F.col("gram"), buckets))
        # a bucket is dealt to several tasks: some trigrams are in every row
        run.write(POSTINGS, found.repartition("bucket", F.pmod("row_id", F.lit(BUCKETS_A_PART)))
                  .sortWithinPartitions("bucket", "gram", "row_id"))
        run.write(GRAMS, run.own(POSTINGS).groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
                  .repartition("bucket").sortWithinPartitions("bucket", "gram"))
        return run.commit(rewrites(ROWS), {OF_QUEUE: of, N_ROWS: n, N_BUCKETS: buckets})
    return attempt(store, "search-index", work)


def last_queue(store: RunStore, upto: int) -> int:
    return max((c.number for c in store.commits() if "review_queue" in c.tables and c.number <= upto), default=0)


def candidates(store: RunStore, query: str, mode: str, upto: int) -> DataFrame | None:
    """``row_id`` of the rows that hold the rarest trigrams of ``query`` in one column;
    ``None`` where a scan is the better way."""
    wanted = query_grams(query, mode)
    n, buckets = store.offset(N_ROWS, upto), store.offset(N_BUCKETS, upto)
    if not wanted or not buckets or store.offset(OF_QUEUE, upto) != last_queue(store, upto):
        return None

    def in_buckets(table: str, grams: list[str]) -> DataFrame:
        own = sorted({zlib.crc32(g.encode()) % buckets for g in grams})
        return store.read(table, upto).where(F.col("bucket").isin(own) & F.col("gram").isin(grams))

    counts = {r["gram"]: r["n"] for r in in_buckets(GRAMS, wanted).collect()}  # at most the query's
    if len(counts) < len(wanted):
        return store.read(ROWS, upto).select("row_id").where("false")
    rarest = sorted(wanted, key=lambda g: (counts[g], g))[:RAREST]
    if counts[rarest[0]] > SCAN_SHARE * n:
        return None
    # further trigrams are only worth their postings where these are few
    rarest = [g for g in rarest if counts[g] <= max(SCAN_SHARE * n, counts[rarest[0]])]
    return in_buckets(POSTINGS, rarest).groupBy("row_id", "field").agg(F.count(F.lit(1)).alias("hits")).where(
        F.col("hits") == len(rarest)).select("row_id").distinct()


def search(store: RunStore, query: str, mode: str = "contains", upto: int | None = None) -> DataFrame:
    """The pending-list columns of the queue rows that match (all, for a blank query)."""
    upto = store.last() if upto is None else upto
    condition = Q.search_filter(query, mode)
    found = candidates(store, query, mode, upto) if condition is not None else None
    if found is None:
        rows = store.read("review_queue", upto).select(*Q.PENDING_COLUMNS)
        return rows if condition is None else rows.where(condition)
    ids, _ = tables.materialize_at(found, "search-hits")
    parts = [r["part"] for r in ids.select(F.shiftright("row_id", ROW_BITS).alias("part")).distinct().collect()]
    rows = store.read(ROWS, upto).where(F.col("part").isin(parts)).where(condition)
    return rows.join(ids, "row_id", "left_semi").select(*Q.PENDING_COLUMNS)


def pending_search(store: RunStore, actions: DataFrame, query: str, mode: str = "contains",
                   limit: int | None = None) -> DataFrame:
    """The pending list's matches, in its order: like ``queue.pending_items`` with
    ``search``, but only matching rows are held against the log."""
    out = Q.pending(search(store, query, mode), actions).orderBy(F.desc("validation_status"), F.asc("email_id"))
    return out.limit(limit) if limit is not None else out
