"""Deterministic global order: seeded shuffle, take, split, batches, sample
(G1-G6, A7).

The order is ``md5(key || '|' || salt), key`` -- portable to DuckDB (both
produce lowercase hex md5), so results are checked against
``row_number() over (order by md5, key)``. Nothing here sorts or windows
the whole table in one partition.

* Take N and the train/test split only need a *cut point*: the key column
  is staged once (reliable checkpoint), bucket counts over the first
  ``hex_digits`` hex digits of the hash (<= 16**hex_digits rows) locate the
  bucket holding the N-th row, and a window over that one bucket finds the
  exact cut. The rows are then filtered map-side and never shuffled.
* A full position index (batches) is ``row_number()`` within each bucket
  plus the bucket's offset from a running sum over the bucket counts; the
  offset table is bounded by construction and broadcast.
* Sampling k rows is a TakeOrdered on the hash (k rows per task).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C

DEFAULT_HEX_DIGITS = 4   # 65,536 buckets: enough parallelism for a large cluster


def shuffle_hash(key: Column, salt: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit("|"), F.lit(str(salt))))


def global_index(df: DataFrame, key: str, salt: str | int = C.SEED, out: str = "idx",
                 hex_digits: int = DEFAULT_HEX_DIGITS, with_total: str | None = None) -> DataFrame:
    """Attach ``out`` = 0-based position in the seeded order (and, when
    ``with_total`` is given, the total row count as that column)."""
    h, b = f"__h_{out}", f"__b_{out}"
    hashed = df.withColumn(h, shuffle_hash(F.col(key), str(salt))) \
        .withColumn(b, F.substring(F.col(h), 1, hex_digits))
    counts = hashed.groupBy(b).agg(F.count(F.lit(1)).alias("__n"))
    # running offsets over <= 16**hex_digits bucket rows; the table is small
    # by construction, so the single-partition window here is bounded
    w = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(b, (F.sum("__n").over(w) - F.col("__n")).alias("__off"),
                            F.sum("__n").over(Window.partitionBy(F.lit(1))).alias("__total"))
    rn = F.row_number().over(Window.partitionBy(b).orderBy(F.col(h), F.col(key)))
    res = hashed.join(F.broadcast(offsets), b) \
        .withColumn(out, (F.col("__off") + rn - 1).cast("long"))
    if with_total:
        res = res.withColumn(with_total, F.col("__total").cast("long"))
    return res.drop(h, b, "__off", "__total")


# G1 -----------------------------------------------------------------------
def seeded_shuffle(df: DataFrame, key: str, seed: int = C.SEED) -> DataFrame:
    """Rows with ``shuffle_idx``: their position after a seeded shuffle.
    The index needs a shuffle of the rows given, so pass a narrow frame
    (key and the columns needed later) when the rows are wide."""
    return global_index(df, key, seed, out="shuffle_idx")


# threshold filters (G2, G3) ---------------------------------------------
def staged_keys(df: DataFrame, key: str) -> DataFrame:
    """The key column, materialized once as a reliable checkpoint in the
    shared checkpoint folder, so that counting and cutting do not re-run
    the (possibly expensive) upstream plan."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.select(key).checkpoint(eager=True)


def _nth_smallest(keys: DataFrame, key: str, salt: str, n: int,
                  hex_digits: int = DEFAULT_HEX_DIGITS):
    """The ``n``-th smallest ``(h, key)`` (1-based) or None when n covers
    every row. Works on the key column only: bucket counts (at most
    ``16**hex_digits`` small rows reach the driver), then a window over the
    single bucket that holds the cut point."""
    if n <= 0:
        return ("", None)
    h = shuffle_hash(F.col(key), salt)
    narrow = keys.select(F.col(key).alias("__k"), h.alias("__h")) \
        .withColumn("__b", F.substring("__h", 1, hex_digits))
    counts = sorted((r["__b"], r["n"]) for r in
                    narrow.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).collect())
    seen = 0
    for bucket, cnt in counts:
        if seen + cnt >= n:
            rank = n - seen
            w = Window.partitionBy("__b").orderBy("__h", "__k")
            row = (narrow.where(F.col("__b") == bucket)
                   .withColumn("__rn", F.row_number().over(w))
                   .where(F.col("__rn") == rank).select("__h", "__k").first())
            return (row["__h"], row["__k"])
        seen += cnt
    return None


def _at_or_before(h: Column, key: Column, cut) -> Column:
    ch, ck = cut
    if ck is None:
        return F.lit(False)
    return (h < F.lit(ch)) | ((h == F.lit(ch)) & (key <= F.lit(ck)))


def first_n(df: DataFrame, key: str, n: int | None, seed: int | str = C.SEED) -> DataFrame:
    """The first ``min(n, available)`` rows of the seeded order, as a
    map-side filter on the rows (they are never shuffled)."""
    if n is None:
        return df
    cut = _nth_smallest(staged_keys(df, key), key, str(seed), int(n))
    if cut is None:
        return df
    return df.where(_at_or_before(shuffle_hash(F.col(key), str(seed)), F.col(key), cut))


def train_test_split(df: DataFrame, key: str, test_fraction: float = C.TEST_FRACTION,
                     seed: int = C.SEED) -> DataFrame:
    """``split`` = 'test' for the first ``ceil(test_fraction * n)`` rows
    of a second seeded order (salt ``split-{seed}``), 'train' for the rest.
    Disjoint and complete by construction; rows are not shuffled."""
    keys = staged_keys(df, key)
    n = keys.count()
    salt = f"split-{seed}"
    cut = _nth_smallest(keys, key, salt, n_test_rows(n, test_fraction))
    h = shuffle_hash(F.col(key), salt)
    is_test = F.lit(True) if cut is None else _at_or_before(h, F.col(key), cut)
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def n_test_rows(n: int, test_fraction: float) -> int:
    return int(math.ceil(test_fraction * n))


# G4 -----------------------------------------------------------------------
def assign_batches(df: DataFrame, idx: str, batch_size: int) -> DataFrame:
    """``batch_id`` and ``row_in_batch`` from an order index."""
    return df.withColumn("batch_id", F.floor(F.col(idx) / batch_size).cast("long")) \
        .withColumn("row_in_batch", (F.col(idx) % batch_size).cast("int"))


# G5 -----------------------------------------------------------------------
def length_grouped_batches(df: DataFrame, idx: str, length: str, batch_size: int,
                           mega_factor: int = 50) -> DataFrame:
    """Group rows of similar length: a megabatch is ``batch_size *
    mega_factor`` consecutive rows of the (shuffled) order; inside it rows
    are sorted by length descending (ties by order index) and cut into
    batches. The window is partitioned by megabatch, so its partitions are
    bounded by ``batch_size * mega_factor`` rows."""
    mega = batch_size * mega_factor
    w = Window.partitionBy("megabatch").orderBy(F.desc(length), F.col(idx))
    return (df.withColumn("megabatch", F.floor(F.col(idx) / mega).cast("long"))
            .withColumn("__pos", F.row_number().over(w) - 1)
            .withColumn("batch_id", (F.col("megabatch") * mega_factor
                                     + F.floor(F.col("__pos") / batch_size)).cast("long"))
            .withColumn("row_in_batch", (F.col("__pos") % batch_size).cast("int"))
            .drop("__pos"))


# G6 -----------------------------------------------------------------------
def sample_k(df: DataFrame, key: str, k: int, seed: int | str = "sample") -> DataFrame:
    """``k`` rows picked by a seeded hash: a TakeOrdered on (hash, key), so
    only ``k`` rows per task travel, never a full sort."""
    h = shuffle_hash(F.col(key), str(seed))
    return df.withColumn("__h", h).orderBy("__h", key).limit(k).drop("__h")


# A7 -----------------------------------------------------------------------
def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
