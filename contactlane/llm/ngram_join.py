"""N-gram Jaccard self-join of texts: classes of documents linked by similarity.

A text's set holds the hashes of its word n-grams. Two texts link when their
sets' Jaccard similarity reaches ``num / den``. The join is exact (up to 64-bit
hash collisions) and runs in these steps:

1. Copies collapse: equal sets share one key, and only one stands for them.
2. Routing. In one global order of n-grams, linked sets share an n-gram within
   their first ``n - ceil(t n) + 1`` ones. N-grams that are frequent anywhere go
   last in that order. All sets with a common leading n-gram belong to the shard
   of the smallest key among them, so every linked pair meets in some shard.
3. T-occurrence search inside shards (DivideSkip): a query's inverted lists
   are split; the short ones are merged on a heap that skips ahead, the long
   ones are probed by binary search for the candidates found, and sets that
   reach the required overlap link. The shard's leader queries first; sets that
   are connected already aren't compared again. Large shards are cut into
   chunks; sets not connected with their leader search the other chunks.
4. Connected components over the links found.

A set is first searched in the shard of its smallest leader; its other shards
are searched only where they hold sets of different components by then.

Defined results: a text with fewer than ``n`` words has its whole sequence as
its one n-gram; NULL, empty and wordless texts have an empty set and link with
nothing; equal texts, repeated rows and repeated ids fall in one class; a NULL
id takes part, but names a class only if no member has an id (then NULL); other
columns are left alone.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shingles, store
from .components import components

# Buckets of word hashes whose loads tell frequent words from rare ones.
WORD_BUCKETS = 1 << 18
# One more leading n-gram for every so many of a set, and one more required.
EXTRA = 20
# How often sets that share too few leading n-grams are taken out.
SIEVES = 2
# Bits of the bitmap of wanted keys (512 KB at most reach each task).
BITMAP_BITS = 22
# Sets and n-grams in one chunk of a shard.
CHUNK_SETS, CHUNK_GRAMS = 256, 1_000_000
# Up to so many places of sets in chunks (some 50 bytes each) are sent to the sets;
# beyond that the sets are shuffled to their places and then to their chunks.
BROADCAST_PLACES = 500_000
# Weight of a binary probe against a heap step when lists are split.
PROBE_WEIGHT = 0.01


def least_overlap(a: int, b: int, num: int, den: int) -> int:
    """Smallest overlap at which sets of these sizes link."""
    return -(-num * (a + b) // (num + den))


# -- T-occurrence search ------------------------------------------------------

def merge_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Members of at least ``least`` of the sorted lists, with their counts. A
    heap holds the front of every list; when the smallest member is too rare,
    the lists that held it and the next smallest fronts skip ahead together."""
    found: dict[int, int] = {}
    at = [0] * len(lists)
    heap = [(own[0], i) for i, own in enumerate(lists) if own]
    heapq.heapify(heap)
    while len(heap) >= least:
        member, popped = heap[0][0], []
        while heap and heap[0][0] == member:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            found[member] = len(popped)
            target = member + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            target = heap[0][0]
        for i in popped:
            own = lists[i]
            j = at[i]
            if own[j] < target:
                j = j + 1 if j + 1 < len(own) and own[j + 1] >= target else bisect_left(own, target, j)
            if j < len(own):
                at[i] = j
                heapq.heappush(heap, (own[j], i))
    return found


class Shard:
    """Inverted index over the sets of one chunk."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.sets = sets
        grams = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(grams, kind="stable")  # of one n-gram, the sets stay in their order
        self.owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[order]
        grams = grams[order]
        new = np.ones(len(grams), bool)
        new[1:] = grams[1:] != grams[:-1]
        self.grams = grams[new]
        self.start = np.append(np.flatnonzero(new), len(grams))

    def search(self, query: np.ndarray, wanted: np.ndarray, num: int, den: int) -> list[int]:
        """Sets among ``wanted`` (boolean by set) that link with ``query``."""
        size = len(query)
        fits = wanted & (self.sizes * den >= size * num) & (size * den >= self.sizes * num)
        if not fits.any():
            return []
        least = least_overlap(size, int(self.sizes[fits].min()), num, den)
        at = np.searchsorted(self.grams, query)
        at = at[(at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == query)]
        lists = [own for i in at if len(own := self.owner[self.start[i]: self.start[i + 1]])]
        lists = [kept for own in lists if len(kept := own[fits[own]])]
        if len(lists) < least:
            return []
        lists.sort(key=len)
        longest = len(lists[-1])
        n_long = min(least - 1, int(least / (PROBE_WEIGHT * np.log2(longest + 1) + 1)))
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long:]
        found = merge_skip([own.tolist() for own in short], least - n_long)
        if not found:
            return []
        cand = np.fromiter(found, np.int32, len(found))
        count = np.fromiter(found.values(), np.int64, len(found))
        need = -(-num * (size + self.sizes[cand]) // (num + den))
        for done, own in enumerate(long):
            if done % 32 == 0:  # a candidate stays while the lists left can still suffice
                stay = count + (len(long) - done) >= need
                cand, count, need = cand[stay], count[stay], need[stay]
                if not len(cand):
                    return []
            i = np.searchsorted(own, cand)
            count = count + (own[np.minimum(i, len(own) - 1)] == cand)
        return cand[count >= need].tolist()


def chunk_links(keys: list[int], sets: list[np.ndarray], queries: list[int], groups: list[int],
                num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect a chunk: each query (index) against all sets not yet
    connected with it. ``groups``: sets of one group count as connected."""
    index = Shard(sets)
    label = np.array(groups)
    links = []
    asked = np.zeros(len(keys), dtype=bool)
    for q in queries:
        wanted = label != label[q]
        wanted &= ~asked
        asked[q] = True
        if not wanted.any():
            continue
        for d in index.search(sets[q], wanted, num, den):
            if label[d] != label[q]:
                links.append((keys[q], keys[d]))
                label[label == label[d]] = label[q]
    return links


# -- Spark side ---------------------------------------------------------------

def word_levels(docs: DataFrame, text: str) -> np.ndarray:
    """How frequent the words of each hash bucket are (powers of two), counted
    over all texts; ``WORD_BUCKETS`` rows reach the driver."""
    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store.keep_nothing()
        total = np.zeros(WORD_BUCKETS, dtype=np.int64)
        shift = np.uint64(64 - WORD_BUCKETS.bit_length() + 1)
        for batch in batches:
            for words, _, _ in shingles.batch_words(batch.column(0)):
                total += np.bincount((words >> shift).astype(np.int64), minlength=WORD_BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    store.ship(docs.sparkSession)
    rows = docs.select(text).mapInArrow(load, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    levels = np.zeros(WORD_BUCKETS, np.uint8)
    levels[rows["bucket"].to_numpy()] = np.log2(rows["n"].to_numpy() + 1.0).astype(np.uint8) + 1
    return levels


def keyed_sets(docs: DataFrame, text: str, n: int, num: int, den: int,
               levels: np.ndarray | None = None) -> DataFrame:
    """``docs`` without its ``text`` column, with ``n_shingles``, ``set_key`` and (given
    ``levels``) ``lead``, the leading n-grams in the global order (empty for a set
    that the same task has met before)."""
    keep = [f for f in docs.schema.fields if f.name not in (text, "n_shingles", "set_key", "lead")]
    names = [f.name for f in keep]
    schema = docs.select(*names).schema.add("n_shingles", "long").add("set_key", "long")
    if levels is not None:
        schema = schema.add("lead", T.ArrayType(T.LongType()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store.keep_nothing()
        sent: set[int] = set()
        for batch in batches:
            sizes, keys, leads = [], [], []
            for grams, level in shingles.batch_sets(batch.column(text), n, levels):
                sizes.append(len(grams))
                keys.append(shingles.set_key(grams))
                if levels is not None:
                    own = grams if keys[-1] not in sent else grams[:0]
                    leads.append(leading(own, level, num, den).view(np.int64))
                    sent.add(keys[-1])
            columns = [batch.column(c) for c in names] + [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())]
            if levels is not None:
                ends = np.cumsum([0] + [len(x) for x in leads])
                flat = np.concatenate(leads) if leads else np.empty(0, np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    store.ship(docs.sparkSession)
    return docs.select(*names, text).mapInArrow(run, schema)


def leading(grams: np.ndarray, level: np.ndarray, num: int, den: int) -> np.ndarray:
    """The n-grams of a set that a linked set must share one of: its first ones
    by their rarest word, then by hash (``grams`` are sorted)."""
    n = len(grams)
    return grams[np.argsort(level, kind="stable")[: n - -(-num * n // den) + 1 + n // EXTRA]] if n else grams


def wanted_bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap over the top bits of the ``k`` wanted; it may let others through."""
    half = 10
    rows = keys.select(F.shiftrightunsigned("k", 64 - BITMAP_BITS).alias("b")).groupBy(
        F.shiftright("b", half).alias("high")).agg(
        F.collect_set((F.col("b") % (1 << half)).cast("short")).alias("low")).collect()
    bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
    for r in rows:
        bits[(r["high"] << half) + np.array(r["low"], dtype=np.int64)] = True
    return np.packbits(bits)


def wanted_sets(docs: DataFrame, text: str, n: int, wanted: DataFrame) -> DataFrame:
    """``k, grams`` (bytes) of the sets whose key is in ``wanted`` (``k``),
    counted again from the texts; a set may come once from each task."""
    bitmap = wanted_bitmap(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store.keep_nothing()
        bits = np.unpackbits(bitmap).view(bool)
        sent: set[int] = set()
        for batch in batches:
            keys, sets = [], []
            for grams, _ in shingles.batch_sets(batch.column(0), n):
                key = shingles.set_key(grams)
                if bits[(key & (1 << 64) - 1) >> (64 - BITMAP_BITS)] and key not in sent:
                    sent.add(key)
                    keys.append(key)
                    sets.append(grams.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["k", "grams"])

    store.ship(docs.sparkSession)
    return docs.select(text).mapInArrow(run, "k long, grams binary")


def search_chunks(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links ``a, b`` found in the chunks ``leader, chunk`` of ``rows`` (``k,
    grams, part, asks``). Sets of one ``part`` count as connected; sets that
    ``asks`` query, the leader first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store.keep_nothing()
        name, chunk = None, {}
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            links = []
            for leader, number, k, grams, part, asks in zip(*cols):
                if (leader, number) != name:
                    links += finish(name, chunk)
                    name, chunk = (leader, number), {}
                if k not in chunk or asks:
                    chunk[k] = (grams, part, asks)
            yield out(links)
        yield out(finish(name, chunk))

    def finish(name, chunk) -> list[tuple[int, int]]:
        if len(chunk) < 2:
            return []
        keys = sorted(chunk, key=lambda k: (k != name[0], len(chunk[k][0]), k))
        part_of = {p: i for i, p in enumerate(dict.fromkeys(chunk[k][1] for k in keys))}
        return chunk_links(keys, [np.frombuffer(chunk[k][0], np.uint64) for k in keys],
                           [i for i, k in enumerate(keys) if chunk[k][2]],
                           [part_of[chunk[k][1]] for k in keys], num, den)

    def out(links) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                           pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    store.ship(rows.sparkSession)
    dealt = rows.select("leader", "chunk", "k", "grams", "part", "asks").repartition(
        "leader", "chunk").sortWithinPartitions("leader", "chunk")
    return dealt.mapInArrow(run, "a long, b long")


def _chunked(members: DataFrame) -> DataFrame:
    """``members`` (``leader, k, n``) with the number of chunks of its shard."""
    shards = members.groupBy("leader").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / CHUNK_SETS), F.ceil(F.sum("n") / CHUNK_GRAMS)).cast("int").alias("chunks"))
    return _with_shard(members, shards)


def _with_shard(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``shards`` (one row for each ``leader``). Joined by
    another form of the key: an exchange of its own lets Spark split a large shard."""
    other = [c for c in shards.columns if c != "leader"]
    return rows.join(shards.select(F.struct("leader").alias("__of"), *other),
                     F.struct("leader") == F.col("__of")).drop("__of")


def _with_sets(places: DataFrame, sets: DataFrame) -> DataFrame:
    """``places`` (``leader, chunk, k, part, asks``) with the sets' ``grams``."""
    places = store.stored(places.select("leader", "chunk", "k", "part", "asks"), "places")
    return sets.join(F.broadcast(places) if places.count() <= BROADCAST_PLACES else places, "k")


def _own_chunk() -> F.Column:
    return F.pmod(F.xxhash64("k", "leader"), F.col("chunks")).cast("int")


def shard_links(docs: DataFrame, text: str, n: int, num: int, den: int, members: DataFrame,
                labels: DataFrame) -> DataFrame:
    """All links needed to connect the shards of ``members`` (``leader, k, n``),
    given the components known so far (``node, label``)."""
    known = members.join(labels.withColumnRenamed("node", "k"), "k", "left").withColumn(
        "part", F.coalesce("label", "k")).drop("label")
    chunked = _chunked(known)
    sets = store.stored(wanted_sets(docs, text, n, members.select("k").distinct()), "sets")
    # Within chunks: everyone asks; the leader stands in every chunk.
    everywhere = F.when(F.col("k") == F.col("leader"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(
        F.array(_own_chunk()))
    inside = chunked.withColumn("chunk", F.explode(everywhere)).withColumn("asks", F.lit(True))
    links = store.stored(search_chunks(_with_sets(inside, sets), num, den), "links")
    store.release(docs.sparkSession)
    # Across chunks: sets that aren't connected with their leader ask the other chunks.
    large = chunked.where("chunks > 1")
    if large.isEmpty():
        return links
    now = components(links.union(labels.select("node", "label")))
    now = large.join(now.withColumnRenamed("node", "k"), "k", "left").withColumn(
        "part", F.coalesce("label", "part")).drop("label")
    led = now.where("k = leader").select("leader", F.col("part").alias("led"))
    now = store.stored(now.join(led, "leader"), "parts")
    store.release(docs.sparkSession)
    asking = now.where("part <> led")
    askers = asking.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / CHUNK_SETS).cast("int").alias("blocks"))
    across = _with_shard(now, askers)
    held = across.withColumn("own", _own_chunk()).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(False))
    asked = across.where("part <> led").withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    asked = asked.withColumn("own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn(
        "asks", F.lit(True))
    both = held.unionByName(asked).withColumn("chunk", F.col("own") * F.col("blocks") + F.col("block"))
    return links.union(search_chunks(_with_sets(both, sets), num, den))


def shard_members(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``leader, k, n``: the shards, from ``rows`` (``set_key, n_shingles, lead``)."""
    posted = rows.select(F.col("set_key").alias("k"), F.explode("lead").alias("gram"))
    # one exchange: the n-grams of all sets are the most that this join moves
    own = W.partitionBy("gram")
    many = posted.withColumns({"lo": F.min("k").over(own), "hi": F.max("k").over(own)}).where("lo < hi")
    shared, path = store.stored_at(many.select("k", "gram").distinct(), "shared-grams")
    store.release(rows.sparkSession)
    sizes = rows.where(F.size("lead") > 0).select(F.col("set_key").alias("k"), F.col("n_shingles").alias("n"))
    sizes = sizes.dropDuplicates(["k"])
    need = 1 + F.floor(F.ceil(F.col("n") * num / den) / EXTRA)
    for i in range(SIEVES):
        fit = shared.groupBy("k").agg(F.count(F.lit(1)).alias("shares")).join(sizes, "k").where(
            F.col("shares") >= need).select("k")
        kept = shared.join(fit, "k")
        many = kept.groupBy("gram").agg(F.min("k").alias("leader"), F.max("k").alias("hi")).where("leader < hi")
        joined = kept.join(many, "gram")
        if i < SIEVES - 1:
            shared, new_path = store.stored_at(joined.select("gram", "k"), "shared-grams")
            store.remove(rows.sparkSession, path)
            path = new_path
    members = joined.select("leader", "k").distinct()
    out = store.stored(members.join(sizes, "k").select("leader", "k", "n"), "members")
    store.remove(rows.sparkSession, path)
    return out


def join_classes(docs: DataFrame, text: str, key: str, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """``(rows, labels)``: ``key, n_shingles, set_key`` of every row, and the
    component ``node, label`` of every set key that links with another one."""
    spark = docs.sparkSession
    with store.scope(spark) as temporary:
        rows, labels = _join(docs.select(key, text), text, n, num, den)
        rows, path = store.stored_at(rows.drop("lead"), "sets-of-rows")
        labels, labels_path = store.stored_at(labels, "labels")
        temporary -= {path, labels_path}
    return rows, labels


def _join(docs: DataFrame, text: str, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    rows = store.stored(keyed_sets(docs, text, n, num, den, word_levels(docs, text)), "set-keys")
    members = shard_members(rows, num, den)
    store.release(spark)
    # First the shard of each set's smallest leader, and the leaders themselves.
    first = members.groupBy("k").agg(F.min("leader").alias("leader"), F.first("n").alias("n"))
    heads = first.select("leader").distinct().join(members.where("k = leader"), "leader")
    first = store.stored(first.select("leader", "k", "n").union(heads.select("leader", "k", "n")).distinct(),
                         "first-shards")
    # (an empty range: local rows would start more Python workers beside those of the join)
    none = spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("label"))
    with store.scope(spark) as temporary:
        links = store.stored(shard_links(docs, text, n, num, den, first, none), "links")
        labels, labels_path = store.stored_at(components(links), "labels")
        temporary -= {labels_path}
    # Then shards whose sets are of several components by now.
    part = members.join(labels.withColumnRenamed("node", "k"), "k", "left").withColumn(
        "part", F.coalesce("label", "k"))
    open_shards = part.groupBy("leader").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where(
        "lo <> hi").select("leader")
    searched = first.groupBy("leader").agg(F.count(F.lit(1)).alias("had"))
    whole = members.groupBy("leader").agg(F.count(F.lit(1)).alias("has"))
    done = searched.join(whole, "leader").where("had = has").select("leader")
    rest = store.stored(members.join(open_shards, "leader", "left_semi").join(done, "leader", "left_anti"),
                        "open-shards")
    if not rest.isEmpty():
        with store.scope(spark) as temporary:
            more = store.stored(shard_links(docs, text, n, num, den, rest, labels), "links")
            if not more.isEmpty():
                labels, labels_path = store.stored_at(components(more.union(labels.select("node", "label"))), "labels")
                temporary -= {labels_path}
    return rows, labels


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 5, num: int = 80,
            den: int = 100) -> DataFrame:
    """``key, n_shingles, component_id`` for every row: the size of its set and
    the smallest ``key`` reachable by links, its own included."""
    rows, labels = join_classes(docs, text, key, n, num, den)
    placed = rows.join(labels, rows["set_key"] == labels["node"], "left").select(
        key, "n_shingles", F.coalesce("label", "set_key").alias("__class"))
    least = placed.where("n_shingles > 0").groupBy("__class").agg(F.min(key).alias("component_id"))
    # joined by another form of the key: an exchange of its own lets Spark split a large class
    least = least.select(F.struct("__class").alias("__of"), "component_id")
    linked = placed.join(least, (F.struct("__class") == F.col("__of")) & (F.col("n_shingles") > 0), "left")
    return linked.select(key, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                         .otherwise(F.col(key)).alias("component_id"))


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 5, num: int = 80,
                    den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each class does: the one
    with the smallest ``key``, NULL last (of several with that key, the first
    by content). Rows with an empty set all stay."""
    rows, labels = join_classes(docs, text, key, n, num, den)
    # Decided on ids and set keys alone; only classes of several rows need it.
    placed = rows.where("n_shingles > 0").join(labels, rows["set_key"] == labels["node"], "left").select(
        "set_key", F.col(key).alias("__key"), F.coalesce("label", "set_key").alias("__class"))
    counts = placed.groupBy("__class", "__key").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("__class").agg(F.sum("n").alias("__rows"), F.min(F.struct(
        F.col("__key").isNull().alias("none"), F.col("__key").alias("key"), "n")).alias("__best"))
    decided = store.stored(placed.select("set_key", "__class").distinct().join(
        best.where("__rows > 1"), "__class").select("set_key", "__class", "__best"), "decided")
    bitmap = wanted_bitmap(decided.select(F.col("set_key").alias("k")))

    @F.arrow_udf("maybe boolean, set_key long")  # texts alone go to the Python workers
    def keyed_text(texts: pa.Array) -> pa.Array:
        store.keep_nothing()
        bits = np.unpackbits(bitmap).view(bool)
        sets = [(len(g), shingles.set_key(g)) for g, _ in shingles.batch_sets(texts, n)]
        maybe = [size > 0 and bool(bits[(k & (1 << 64) - 1) >> (64 - BITMAP_BITS)]) for size, k in sets]
        return pa.StructArray.from_arrays(
            [pa.array(maybe, pa.bool_()), pa.array([k for _, k in sets], pa.int64())], names=["maybe", "set_key"])

    # Rows whose class surely has no other row pass by; only the others' texts move.
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), keyed_text(F.col(text)).alias("__set")).select(
        "__row", "__set.*")
    joined = keyed.where("maybe").join(decided, "set_key", "left")
    kept = joined.where(F.col("__class").isNull() | F.col("__row")[key].eqNullSafe(F.col("__best.key")))
    alone = F.col("__class").isNull() | (F.col("__best.n") == 1)
    several = kept.where(~alone).groupBy("__class").agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    return keyed.where("NOT maybe").select("__row").union(kept.where(alone).select("__row")).union(
        several.select("__row")).select("__row.*")
