"""Merkle manifest of a table: a digest tree per group, and one over the groups.

Leaves are ordered within their tree (a group of rows, e.g. a source); every
``FAN`` consecutive nodes become the digest of their digests' text until one is
left, and the subroots, ordered by name, form one more tree above.

The nodes are kept content-addressed: records name a digest and its children.
They are written in spans of ``levels`` tree levels, one row per span with the
records below its top, so a tree of any height takes a few Spark jobs and no
task holds more than one span (``FAN ** levels`` leaves). Requests for leaves
descend from the root: the digits of a leaf's rank (base ``FAN``) choose the
child at each node and the unselected children are collected. A span hands the
path walked so far on to the spans below; at the leaves the segments are
reversed into a proof, read from the leaf up to the root.

Ranks come from a range-partitioned sort and the offsets of its partitions, so
no tree, however large, is ordered in one task. Nothing is joined on a digest or
a tree alone; a span's path, records and requests meet in one sorted stream.

Defined results: a NULL tree is a tree of its own and comes first; rows of one
tree with equal keys (or none; NULL keys come first) are ordered by digest, and
repeated rows each have their own place; a tree of one leaf has it as its
subroot; an empty table gives no rows; other columns are not read. A leaf that
the stored records don't lead to is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store

FAN, LEVELS = 3, 6
DIGEST = 64  # hex digits
PART_BITS = 33  # of monotonically_increasing_id: rows within a partition
PATH, RECORDS, REQUEST = 0, 1, 2


def digest_of(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field is ``-`` if NULL, else its UTF-8 length, ``:``
    and its text."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(f) for f in fields]).cast("binary"), 256)


def combined(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(total: int) -> int:
    """Levels above ``total`` leaves."""
    h = 0
    while total > 1:
        total, h = -(-total // FAN), h + 1
    return h


def span_levels(total: int, layer: int, levels: int) -> int:
    """Levels of a tree of ``total`` leaves that its spans of ``layer`` hold."""
    return min(levels, max(0, height(total) - layer * levels))


def span_records(digests: list[str], levels: int) -> tuple[str, dict[str, list[str]]]:
    """The top digest above consecutive nodes, and every node's children."""
    records: dict[str, list[str]] = {}
    for _ in range(levels):
        above = []
        for i in range(0, len(digests), FAN):
            children = digests[i:i + FAN]
            above.append(combined(children))
            records[above[-1]] = children
        digests = above
    return digests[0], records


def descend(top: str, records: dict[str, list[str]], rank: int, levels: int) -> tuple[str, list[str]]:
    """Walk from ``top`` by the digits of ``rank``: the node reached, and for each
    level the digit followed by the unselected children."""
    node, segment = top, []
    for level in range(levels - 1, -1, -1):
        children, digit = records[node], rank // FAN ** level % FAN
        segment.append(str(digit) + "".join(children[:digit] + children[digit + 1:]))
        node = children[digit]
    return node, segment


def fold(leaf: str, proof: Iterable[str]) -> str:
    """The root that ``leaf`` leads to with a proof (leaf to root)."""
    for step in proof:
        cut, siblings = int(step[0]) * DIGEST, step[1:]
        leaf = combined((siblings[:cut], leaf, siblings[cut:]))
    return leaf


def siblings_text(proof: Column) -> Column:
    """The siblings of a proof alone, joined from the leaf's level to the root's."""
    return F.array_join(F.transform(proof, lambda step: F.substring(step, 2, DIGEST * FAN)), "")


# -- ranks ----------------------------------------------------------------------

def ranked(rows: DataFrame, name: str) -> tuple[DataFrame, str, int]:
    """``rows`` (``tree, key, digest, ...``) with ``idx`` (the place within the
    tree by key, then digest) and ``total`` (its leaves); the written table's
    path, to be removed after use; and the largest total."""
    spark = rows.sparkSession
    order = [F.asc_nulls_first("tree"), F.asc_nulls_first("key"), F.asc("digest"), F.asc("__salt")]
    # the salt lets a run of equal rows be cut between partitions
    spread = rows.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange(*order)
    in_order = spread.sortWithinPartitions(*order).drop("__salt").withColumn(
        "__at", F.monotonically_increasing_id())
    placed, path = store.stored_at(in_order, name)
    placed = placed.withColumns({"__part": F.shiftright("__at", PART_BITS),
                                 "__pos": F.col("__at").bitwiseAND((1 << PART_BITS) - 1)})
    runs = placed.groupBy("__part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("__pos").alias("first"))
    own = W.partitionBy("tree")
    runs = runs.select(
        F.col("__part").alias("r_part"), F.col("tree").alias("r_tree"), "first",
        F.coalesce(F.sum("n").over(own.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"),
        F.sum("n").over(own).alias("total"))
    runs, runs_path = store.stored_at(runs, f"{name}-runs")
    largest = runs.agg(F.max("total")).first()[0] or 0
    joined = placed.join(runs, (F.col("__part") == F.col("r_part")) & F.col("tree").eqNullSafe(F.col("r_tree")))
    out = joined.select(*rows.columns, (F.col("__pos") - F.col("first") + F.col("before")).alias("idx"), "total")
    done, done_path = store.stored_at(out, f"{name}-ranked")
    store.remove(spark, path)
    store.remove(spark, runs_path)
    return done, done_path, largest


# -- spans ------------------------------------------------------------------------

def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by their first two columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield key, rows


def _in_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_TEXTS = pa.list_(pa.string())


def build_spans(nodes: DataFrame, layer: int, levels: int) -> DataFrame:
    """The spans above ``nodes`` (``tree, idx, total, digest``): ``tree, idx, total,
    digest`` of their tops and the ``records`` below (digest, then children)."""
    span = FAN ** levels
    out = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("total", pa.int64()),
                     ("digest", pa.string()), ("records", _TEXTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans() -> Iterator[tuple]:
            for (tree, group), rows in _groups(batches):
                total = rows[0][1]
                top, records = span_records([r[2] for r in rows], span_levels(total, layer, levels))
                yield tree, group, total, top, [d + "".join(c) for d, c in records.items()]
        yield from _in_batches(spans(), out, 20)

    store.ship(nodes.sparkSession)
    grouped = nodes.select("tree", F.expr(f"idx div {span}").alias("span"), "idx", "total", "digest")
    return grouped.repartition("tree", "span").sortWithinPartitions("tree", "span", "idx").mapInArrow(
        run, "tree string, idx long, total long, digest string, records array<string>")


def _stream(layer_spans: DataFrame, paths: DataFrame, requests: DataFrame, levels: int, key: T.DataType) -> DataFrame:
    """Path, records and requests of each span, in this order."""
    none = F.lit(None)
    parts = [
        paths.select("tree", F.col("idx").alias("span"), F.lit(PATH).alias("kind"), F.lit(0).cast("long").alias("idx"),
                     none.cast("long").alias("total"), none.cast("string").alias("digest"),
                     F.col("path").alias("texts"), F.col("subroot").alias("other"), none.cast(key).alias("key")),
        layer_spans.select("tree", F.col("idx").alias("span"), F.lit(RECORDS).alias("kind"),
                           F.lit(0).cast("long").alias("idx"), "total", "digest", F.col("records").alias("texts"),
                           none.cast("string").alias("other"), none.cast(key).alias("key")),
        requests.select("tree", F.expr(f"idx div {FAN ** levels}").alias("span"), F.lit(REQUEST).alias("kind"), "idx",
                        "total", "digest", none.cast("array<string>").alias("texts"), "other", "key")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.repartition("tree", "span").sortWithinPartitions("tree", "span", "kind", "idx")


def walk(layer_spans: DataFrame, paths: DataFrame, requests: DataFrame, layer: int, levels: int,
         last: bool) -> DataFrame:
    """Send the requests (``tree, idx, total, digest, other, key``) of one layer down
    from the tops of their spans. Gives ``tree, idx, key, digest, other, subroot,
    path``; in the last layer ``path`` is the proof, and ``folded`` the root that
    ``other`` (else the digest) leads to."""
    span, key_type = FAN ** levels, requests.schema["key"].dataType
    fields = "tree string, idx long, digest string, other string, subroot string, path array<string>, folded string"
    schema = T.StructType(T.StructType.fromDDL(fields).fields + [T.StructField("key", key_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers(groups: Iterator[tuple[tuple, list[tuple]]]) -> Iterator[tuple]:
            for (tree, group), rows in groups:
                path, records, top, subroot, down = None, None, None, None, 0
                for kind, idx, total, digest, texts, other, key in rows:
                    if kind == PATH:
                        path, subroot = texts, other
                    elif kind == RECORDS:
                        records = {t[:DIGEST]: [t[i:i + DIGEST] for i in range(DIGEST, len(t), DIGEST)] for t in texts}
                        top, down = digest, span_levels(total, layer, levels)
                    else:
                        node, segment = descend(top, records, idx - group * span, down)
                        if node != digest:
                            raise ValueError(f"the records of tree {tree!r} don't lead to leaf {idx}")
                        steps = path + segment
                        folded = None
                        if last:
                            steps.reverse()
                            folded = fold(other or digest, steps)
                        yield tree, idx, digest, other, subroot, steps, folded, key
        first = next(batches, None)
        if first is not None:
            out = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("digest", pa.string()),
                             ("other", pa.string()), ("subroot", pa.string()), ("path", _TEXTS),
                             ("folded", pa.string()), ("key", first.schema.field("key").type)])

            def whole() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches
            yield from _in_batches(answers(_groups(whole())), out)

    return _stream(layer_spans, paths, requests, levels, key_type).mapInArrow(run, schema)


def _climb(nodes: DataFrame, largest: int, levels: int, name: str) -> tuple[list[DataFrame], list[str]]:
    """The stored spans of every layer above ``nodes``, bottom first."""
    spans, paths = [], []
    for layer in range(max(1, -(-height(largest) // levels))):
        own, path = store.stored_at(build_spans(spans[-1] if spans else nodes, layer, levels), f"{name}-{layer}")
        spans.append(own)
        paths.append(path)
    return spans, paths


def _as_requests(spans: DataFrame, key: T.DataType) -> DataFrame:
    return spans.select("tree", "idx", "total", "digest", F.lit(None).cast("string").alias("other"),
                        F.lit(None).cast(key).alias("key"))


def _down(spans: list[DataFrame], paths: DataFrame, leaves: DataFrame, levels: int, last: bool) -> DataFrame:
    key = leaves.schema["key"].dataType
    for layer in range(len(spans) - 1, 0, -1):
        paths = walk(spans[layer], paths, _as_requests(spans[layer - 1], key), layer, levels, False)
    return walk(spans[0], paths, leaves, 0, levels, last)


def manifest(df: DataFrame, leaf: Column, claimed: Column, tree: str = "source", key: str = "doc_id",
             levels: int = LEVELS) -> DataFrame:
    """``tree, key, leaf, subroot, root, proof, folded_root, verified`` of every row.

    ``leaf`` is a row's digest in the manifest, ``claimed`` the digest of the row
    as it is now: it is folded with the proof's siblings and ``verified`` tells
    whether it leads to the root. ``proof`` has a text for each level from leaf to
    root: the node's place in its run, then its siblings' digests.
    """
    spark: SparkSession = df.sparkSession
    digests, digests_path = store.stored_at(
        df.select(F.col(tree).cast("string").alias("tree"), F.col(key).alias("key"), leaf.alias("digest"),
                  claimed.alias("other")).withColumn("other", F.nullif("other", "digest")), "merkle-digests")
    leaves, _, largest = ranked(digests, "merkle-leaves")
    store.remove(spark, digests_path)
    spans, _ = _climb(leaves, largest, levels, "merkle-spans")
    none = F.lit(None).cast("string")
    tops, _, trees = ranked(spans[-1].select(none.alias("tree"), F.col("tree").alias("key"), "digest",
                                             none.alias("other")), "merkle-tops")
    over, over_paths = _climb(tops, trees, levels, "merkle-over")
    root = over[-1].first()
    start = spark.createDataFrame([(None, 0, [], None)], "tree string, idx long, path array<string>, subroot string")
    paths = _down(over, start, tops, levels, False).select(
        F.col("key").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.col("digest").alias("subroot"))
    proofs = _down(spans, paths, leaves, levels, True)
    return proofs.select(
        F.col("tree").alias(tree), F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"), F.col("path").alias("proof"),
        F.col("folded").alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
