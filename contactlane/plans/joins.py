"""Join strategies that stay safe when one key holds a large share of rows.

Nothing is counted and nothing runs while a plan is built: joins are planned as
shuffles, and AQE turns one into a broadcast at run time when the exact size of
a side's shuffle is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(scans are judged by their size in bytes). Beyond that:

* rows whose key is NULL -- they can never match -- are spread over all
  partitions with a deterministic salt instead of all hashing to one partition;
* a hot non-NULL key (say a third of all rows) is split by AQE's skew join: both
  join inputs are kept as plain shuffles, which that rule needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import materialize

# Columns that may hold long texts; the salt of a NULL key never reads them.
LONG_COLUMNS = ("body", "email_body", "message_body", "source_email_body", "raw", "response", "text")
SALT_COLUMNS = 4


def salt_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def null_key_salt(df: DataFrame, key: str, buckets: int) -> Column:
    """0 for rows with a key; 1..buckets, from a hash of a few short columns of
    the row, for NULL keys."""
    short = [f.name for f in df.schema.fields
             if f.name != key and f.name not in LONG_COLUMNS
             and isinstance(f.dataType, (T.StringType, T.NumericType, T.BooleanType, T.DateType,
                                         T.TimestampType, T.TimestampNTZType))]
    salt = F.pmod(F.xxhash64(*short[:SALT_COLUMNS]), F.lit(buckets)) + 1 if short else F.lit(1)
    return F.when(F.col(key).isNull(), salt).otherwise(F.lit(0)).cast("long")


def _key_type(df: DataFrame, key: str) -> str:
    return f"struct<k:{df.schema[key].dataType.simpleString()},s:bigint>"


def key_struct(df: DataFrame, key: str, key_type: str) -> Column:
    """The key side of a salted join: ``struct(key, 0)`` of type ``key_type``.

    Both sides get the same explicit struct type (nullability included), so
    the planner adds no cast -- and thus no extra exchange -- between the key
    side's de-duplication and the join.
    """
    return F.struct(F.col(key).alias("k"), F.lit(0).cast("long").alias("s")).cast(key_type)


def salted_key(df: DataFrame, key: str) -> Column:
    """Join key ``struct(key, salt)``: salt 0 for rows with a key, 1..n for
    NULL keys. The key side uses ``struct(key, 0)``; being one struct, the
    salt cannot be folded away from the join keys by the optimizer."""
    buckets = salt_partitions(df)
    return (F.struct(F.col(key).alias("k"), null_key_salt(df, key, buckets).alias("s"))
            .cast(_key_type(df, key)))


def _distinct_keys(left: DataFrame, keys: DataFrame, left_key: str, key: str, out: str) -> DataFrame:
    """The key side: distinct raw keys (map-side first, so hot keys collapse
    before the shuffle), then an exchange of its own into the join, which is
    what AQE needs to split a hot key of the left side."""
    present = keys.where(F.col(key).isNotNull())
    return present.select(F.col(key)).distinct().select(
        key_struct(present, key, _key_type(left, left_key)).alias(out))


def exists_flag(left: DataFrame, keys: DataFrame, left_key: str, key: str, out: str) -> DataFrame:
    """``left`` plus boolean ``out``: does ``left[left_key]`` occur in ``keys[key]``?

    Keeps every left row exactly once. A NULL left key gives ``false``.
    """
    hits = _distinct_keys(left, keys, left_key, key, "_ex_rkey").withColumn("_ex_hit", F.lit(True))
    salted = left.withColumn("_ex_lkey", salted_key(left, left_key))
    joined = salted.join(hits, F.col("_ex_lkey") == F.col("_ex_rkey"), "left").drop("_ex_lkey", "_ex_rkey")
    return joined.withColumn(out, F.coalesce(F.col("_ex_hit"), F.lit(False))).drop("_ex_hit")


# A filter of so many 64-bit words at most is sent to every executor (some 40 MB).
FILTER_WORDS = 1 << 20
BITS_PER_KEY = 16


def key_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int] | None:
    """A bitmap of the hashes of ``keys[key]`` as ``word, bits`` rows, and its number of
    bits -- set from the number of distinct keys; ``None`` where it would take
    more than ``FILTER_WORDS`` words."""
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    size = 1 << max(10, (BITS_PER_KEY * n - 1).bit_length())
    if size // 64 > FILTER_WORDS:
        return None
    at = _bit_of(F.col(key), size)
    words = keys.where(F.col(key).isNotNull()).groupBy(F.shiftright(at, 6).alias("_f_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))).alias("_f_bits"))
    return words, size


def _bit_of(key: Column, size: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(size - 1).cast("long"))


def exists_flag_filtered(left: DataFrame, keys: DataFrame, left_key: str, key: str, out: str) -> DataFrame:
    """:func:`exists_flag` that shuffles possible hits only.

    A bitmap of the keys' hashes tells sure misses where they are read; only
    the other rows (all hits and a few per cent of the misses) are joined. ``left``
    is read twice, so it should be a stored table or a plain scan; it pays where
    many keys are unknown. Without a filter of bounded size it is the plain join.
    """
    known = materialize(keys.select(F.col(key).cast(left.schema[left_key].dataType).alias(key))
                        .where(F.col(key).isNotNull()).distinct(), "lookup-keys")
    made = key_filter(known, key)
    if made is None:
        return exists_flag(left, known, left_key, key, out)
    words, size = made
    at = _bit_of(F.col(left_key), size)
    probed = left.withColumn("_f_at", F.when(F.col(left_key).isNotNull(), at)).join(
        F.broadcast(words), F.shiftright("_f_at", 6) == F.col("_f_word"), "left")
    maybe = F.coalesce(F.expr("bit_get(_f_bits, CAST(_f_at & 63 AS INT)) = 1"), F.lit(False))
    probed = probed.withColumn("_f_maybe", maybe)
    hits = exists_flag(probed.where("_f_maybe").select(*left.columns), known, left_key, key, out)
    misses = probed.where("NOT _f_maybe").select(*left.columns, F.lit(False).alias(out))
    return hits.unionByName(misses)


def anti_join(left: DataFrame, keys: DataFrame, left_key: str, key: str) -> DataFrame:
    """Rows of ``left`` whose key is not among ``keys[key]`` (NULL keys are kept)."""
    seen = _distinct_keys(left, keys, left_key, key, "_aj_rkey")
    salted = left.withColumn("_aj_lkey", salted_key(left, left_key))
    return salted.join(seen, F.col("_aj_lkey") == F.col("_aj_rkey"), "left_anti").drop("_aj_lkey")


def semi_join(left: DataFrame, keys: DataFrame, left_key: str, key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``keys[key]`` (a filter, no duplication)."""
    wanted = _distinct_keys(left, keys, left_key, key, "_sj_rkey")
    salted = left.where(F.col(left_key).isNotNull()).withColumn("_sj_lkey", salted_key(left, left_key))
    return salted.join(wanted, F.col("_sj_lkey") == F.col("_sj_rkey"), "left_semi").drop("_sj_lkey")


def lookup(left: DataFrame, right: DataFrame, left_key: str, key: str) -> DataFrame:
    """Left join of ``right`` (one row per ``key``) onto ``left``: every left
    row once, right's other columns NULL when there is no match."""
    r = right.withColumn("_lk_rkey", key_struct(right, key, _key_type(left, left_key))).drop(key)
    salted = left.withColumn("_lk_lkey", salted_key(left, left_key))
    return (salted.join(r, F.col("_lk_lkey") == F.col("_lk_rkey"), "left")
            .drop("_lk_lkey", "_lk_rkey"))


def one_per_key(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """One ``value`` per ``key`` (the smallest), partial-aggregated before the shuffle."""
    return df.groupBy(key).agg(F.min(value).alias(out or value))


def one_row_per_key(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """One row per non-NULL ``key``: the largest by ``order``, then by the other
    columns in their order. A plain aggregate (max of a struct)."""
    first = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in first and c != key]
    best = F.max(F.struct(*first, *rest)).alias("_best")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(
        *[F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns])
