"""Mixing sources to target weights.

Every source's texts are laid end to end in a seeded order and packed into
blocks of ``block_words`` words. The mix is a sequence of slots, dealt over
output shards of ``shard_slots``; each slot holds one block.

* Targets: sources share all words by weight, but none is taken more than
  ``max_epochs`` times; what that leaves over is shared again by weight.
* Shard counts: how many slots of a shard each source gets is a multinomial
  draw conditioned on the sources' totals. It is drawn down a binary tree
  over the shards: each node splits its totals between its halves by a
  hypergeometric draw seeded by the node, so any shard finds its own counts
  and running offsets alone, in log(shards) steps, and the totals come out exact.
* Slots: the j-th slot of a source goes to block ``perm(j)``; every pass over
  the source has its own pseudorandom permutation of the block indexes (a
  Feistel network with cycle walking), so each pass takes every block once.
* Slots and blocks are joined by (source, block index).

The words a document contributes follow from the blocks it lies in. Offsets
come from sums over small buckets of documents, then over groups of buckets,
so that a hot source is never ordered in one task. What is broadcast is one
row per source and only if there are at most ``BROADCAST_SOURCES`` of them.

Defined results: null and empty texts have size 0 and are never taken; null
is a source of its own, the last; repeated rows are separate documents; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bind, cut_lineage, narrow, python_ready, row_id, scratch, table, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
BUCKET_DOCS, GROUP_BUCKETS = 128, 1024
BROADCAST_SOURCES = 50_000
#: Largest sum that numpy's hypergeometric draw takes; beyond it the same draw is made by rejection.
LIBRARY_SLOTS = 500_000_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the public splitmix64)."""
    x = (x + _U(0x9E3779B97F4A7C15))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Position of ``index`` in the pseudorandom permutation of ``range(size)``
    chosen by ``key`` (all uint64 arrays of one length)."""
    with np.errstate(over="ignore"):
        half = _U(1) + np.floor(np.log2(np.maximum(size, _U(2)).astype(np.float64)) / 2).astype(np.uint64)
        mask = (_U(1) << half) - _U(1)
        out, todo = index.copy(), np.arange(len(index))
        while len(todo):
            x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
            left, right = x >> h, x & m
            for r in range(6):
                left, right = right, left ^ (_mix(right ^ _mix(k + _U(r))) & m)
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= size[todo]]       # outside: walk on along the cycle
        return out


def _halve(totals: np.ndarray, first: int, draws: int, seed: int, node: int) -> np.ndarray:
    """How many of each source's ``totals`` fall to the first ``draws`` slots."""
    n = int(totals.sum())
    rng = np.random.Generator(np.random.Philox(key=[seed & (2**64 - 1), node]))
    if n <= LIBRARY_SLOTS:
        return rng.multivariate_hypergeometric(totals, draws, method="marginals")
    return _hypergeometric(rng, totals, draws)


def _log_binomial(k: float, n: int, p: float) -> float:
    """Log probability of k of n, by the saddle-point form, whose terms keep
    their precision for large n (Loader 2000)."""
    def deviance(x, mean):
        d = (x - mean) / mean
        # x * log(x / mean) + mean - x
        return mean * ((1 + d) * math.log1p(d) - d) if x > 0 else mean

    def stirling(x):
        return math.lgamma(x + 1) - (x + 0.5) * math.log(x) + x - 0.5 * math.log(2 * math.pi) if x < 1000 else 1 / (12 * x) - 1 / (360 * x**3)

    if k <= 0 or k >= n:
        return n * math.log1p(-p) if k == 0 else n * math.log(p) if k == n else -math.inf
    return (stirling(n) - stirling(k) - stirling(n - k) - deviance(k, n * p) - deviance(n - k, n * (1 - p))
            + 0.5 * math.log(n / (2 * math.pi * k * (n - k))))


def _hypergeometric(rng, totals: np.ndarray, draws: int) -> np.ndarray:
    """Multivariate hypergeometric draw of any size: independent binomial
    draws, given that they sum to ``draws``. The largest source takes what the
    others leave, which is accepted by that number's binomial probability."""
    p = draws / int(totals.sum())
    big = int(np.argmax(totals))
    n = int(totals[big])
    top = _log_binomial(min(n, int((n + 1) * p)), n, p)
    while True:
        got = rng.binomial(totals, p)
        rest = draws - int(got.sum() - got[big])
        if 0 <= rest <= n and math.log(1 - rng.random()) <= _log_binomial(rest, n, p) - top:
            got[big] = rest
            return got


def shard_counts(slots: np.ndarray, shards: Iterator[int], shard_slots: int, seed: int):
    """Yield (shard, offsets, counts) by source for the given shard numbers
    (ascending numbers share their upper nodes)."""
    total = int(slots.sum())
    n_shards = -(-total // shard_slots)
    cache: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def walk(shard: int):
        lo, hi, node = 0, n_shards, 1
        off, have = np.zeros_like(slots), slots
        kept: set[int] = set()
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if node not in cache:
                cut = min(mid * shard_slots, total) - lo * shard_slots
                cache[node] = (off, have, _halve(have, lo, cut, seed, node))
            kept.add(node)
            off, have, left = cache[node]
            if shard < mid:
                hi, have, node = mid, left, node * 2
            else:
                lo, off, have, node = mid, off + left, have - left, node * 2 + 1
        for old in [k for k in cache if k not in kept]:
            del cache[old]
        return off, have

    for s in shards:
        yield (s, *walk(s))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From (source, source_size, n_docs) one row per source with sid (0..),
    weight and target. The table has one row per source, so its windows run in one task."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.select("*", (F.row_number().over(order) - 1).cast("long").alias("sid"))
    s = s.withColumn("weight", F.get(w, F.col("sid") % len(weights)))
    s = s.withColumn("limit", F.col("source_size") * float(max_epochs))
    # sources reach their limit in the order of limit / weight; those before the first
    # whose share of the rest stays within it are held at their limits
    by = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    s = s.withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    s = s.withColumn("rate", F.col("rest") / F.sum("weight").over(after))
    fits = F.col("rate") * F.col("weight") <= F.col("limit")
    s = s.withColumn("level", F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), F.col("sid"), F.col("rate").alias("r"))))
                     .over(every)["r"])
    return s.select("sid", "source", "source_size", "n_docs", "weight", F.coalesce(
        F.least(F.col("limit"), F.col("level") * F.col("weight")), F.col("limit")).alias("target"))


def _offsets(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, sid, n_docs, size, tie) with ``start``: its first word's place in its source."""
    row = ["__row"] if "__row" in docs.columns else []
    buckets = F.ceil(F.col("n_docs") / BUCKET_DOCS).cast("long")
    d = docs.withColumn("b", F.pmod(F.xxhash64(F.col("doc_id"), F.col("tie"), F.lit("bucket")), buckets))
    sums = d.groupBy("sid", "b").agg(F.sum("size").alias("n")).withColumn("g", F.floor(F.col("b") / GROUP_BUCKETS))
    run = Window.unboundedPreceding
    groups = sums.groupBy("sid", "g").agg(F.sum("n").alias("n"))
    groups = groups.select("sid", "g", (F.sum("n").over(Window.partitionBy("sid").orderBy("g").rowsBetween(run, 0)) - F.col("n")).alias("g_start"))
    sums = sums.withColumn("b_start", F.sum("n").over(
        Window.partitionBy("sid", "g").orderBy("b").rowsBetween(run, 0)) - F.col("n"))
    starts = sums.join(groups, ["sid", "g"]).select("sid", "b", (F.col("g_start") + F.col("b_start")).alias("b_start"))
    within = F.sum("size").over(Window.partitionBy("sid", "b").orderBy("doc_id", "size", "tie", *row)
                                .rowsBetween(run, 0)) - F.col("size")
    return d.withColumn("within", within).join(starts, ["sid", "b"]).withColumn(
        "start", (F.col("b_start") + F.col("within")).cast("long"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, seed: int = 17):
    """Plan the mix of ``docs`` (doc_id, text, source, and ``__row`` if the
    rows are numbered). Returns three frames:

    ``documents``: doc_id, tie (hash of the text), source, size, sid, start,
    source_size, target, and ``__row`` if given; ``blocks``: sid, block, doc_id, start, first (word of
    the block), n_words: which document's words each block holds; ``slots``: shard, slot, sid,
    block, take (words; below ``block_words`` only where a source's quota ends)."""
    spark = docs.sparkSession
    python_ready(spark)
    row = ["__row"] if "__row" in docs.columns else []
    d = narrow(docs, {"doc_id": "long", "text": "string", "source": "string"} | dict.fromkeys(row, "long"))
    d = cut_lineage(d.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                             F.xxhash64("text").alias("tie"), *row))
    by_source = targets(d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")),
                        weights, max_epochs)
    by_source = cut_lineage(by_source.repartition(1))
    few = by_source.count() <= BROADCAST_SOURCES
    side = F.broadcast(by_source) if few else by_source
    d = cut_lineage(_offsets(d.join(side, d["source"].eqNullSafe(by_source["source"])).select(
        "doc_id", d["source"], "size", "tie", "sid", "source_size", "n_docs", "target", *row)).drop("b", "within", "b_start", "n_docs"))

    # the sources' quotas in words and slots: whole passes, then part of one more
    quota = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0)
    n_blocks = F.ceil(F.col("source_size") / block_words)
    plan = by_source.select("sid", n_blocks.alias("n_blocks"), passes.alias("passes"),
                            (quota - passes * F.col("source_size")).alias("rest")).orderBy("sid").toPandas()
    blocks = plan["n_blocks"].to_numpy(np.int64)
    slots = plan["passes"].to_numpy(np.int64) * blocks + -(-plan["rest"].to_numpy(np.int64) // block_words)
    rest = plan["rest"].to_numpy(np.int64)
    n_shards = int(-(-slots.sum() // shard_slots))

    def deal(batches: Iterator) -> Iterator:
        import pandas as pd
        n_blk, seed64 = blocks.astype(np.uint64), _U(seed)
        for pdf in batches:
            for shard, off, have in shard_counts(slots, sorted(pdf["id"]), shard_slots, seed):
                sid = np.repeat(np.arange(len(slots)), have)
                n = len(sid)
                j = np.arange(n) - np.repeat(np.cumsum(have) - have, have) + off[sid]
                with np.errstate(over="ignore"):
                    epoch = j // blocks[sid]
                    key = _mix(_mix(seed64 + sid.astype(np.uint64)) + epoch.astype(np.uint64))
                    block = permute((j % blocks[sid]).astype(np.uint64), n_blk[sid], key).astype(np.int64)
                    place = np.argsort(_mix(key + j.astype(np.uint64) * _U(0xD6E8FEB86659FD93)), kind="stable")
                slot = np.empty(n, np.int64)
                slot[place] = np.arange(n)
                last = (j == slots[sid] - 1) & (rest[sid] % block_words > 0)
                yield pd.DataFrame({"shard": np.int64(shard), "slot": slot, "sid": sid.astype(np.int64), "block": block,
                                    "take": np.where(last, rest[sid] % block_words, block_words).astype(np.int64)})

    tasks = max(1, min(n_shards, max(spark.sparkContext.defaultParallelism, n_shards // 64)))
    dealt = spark.range(0, n_shards, 1, tasks).mapInPandas(
        deal, "shard long, slot long, sid long, block long, take long")

    at = F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)))
    held = d.where("size > 0").select("sid", "doc_id", "start", "size", at.alias("block"))
    first = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0))
    end = F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words))
    held = held.select("sid", "block", "doc_id", "start", first.alias("first"), (end - first).alias("n_words"))
    return d, held, dealt


def taken_words(documents: DataFrame, blocks: DataFrame, slots: DataFrame) -> DataFrame:
    """``documents`` with ``taken``: the words of each that the slots hold."""
    uses = slots.groupBy("sid", "block", "take").agg(F.count(F.lit(1)).alias("times"))
    used = F.greatest(F.least(F.col("first") + F.col("n_words"), F.col("take")) - F.col("first"), F.lit(0)) * F.col("times")
    # sized by the shard numbers alone, the slots would look small enough to broadcast
    got = blocks.join(uses.hint("merge"), ["sid", "block"]).groupBy("sid", "start").agg(F.sum(used).cast("long").alias("taken"))
    full = documents.where("size > 0").join(got.hint("merge"), ["sid", "start"], "left")
    return full.unionByName(documents.where("size = 0").withColumn("taken", F.lit(0).cast("long"))) \
        .withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: the rows of ``docs`` (doc_id, text, source,
    n_chars and others) with the words the slots take of them, in their
    order and with the white space that follows them. Words taken k times are
    in k rows of the document; untaken documents are left out, so texts without words
    and an empty table give no rows. Rows equal in all columns are documents
    of their own; n_chars is set anew, other columns are kept, whatever their names."""
    names = docs.columns
    key = row_id(docs, names)
    block_words = options.get("block_words", BLOCK_WORDS)
    with scratch(docs.sparkSession) as scope:
        documents, blocks, slots = mix(docs.select("doc_id", "text", "source", key.alias("__row")), **options)
        uses = slots.groupBy("sid", "block", "take").agg(F.count(F.lit(1)).alias("times"))
        here = F.least(F.col("first") + F.col("n_words"), F.col("take")) - F.col("first")
        got = blocks.join(uses.hint("merge"), ["sid", "block"]).where(here > 0).select(
            "sid", "start", (F.col("block") * F.lit(block_words) + F.col("first") - F.col("start")).alias("at"), here.alias("n"), "times")
        # a document's parts: bounded by its own length
        parts = got.groupBy("sid", "start").agg(F.sort_array(F.collect_list(F.struct("at", "n", "times"))).alias("parts"))
        parts = cut_lineage(documents.where("size > 0").join(parts.hint("merge"), ["sid", "start"]).select("__row", "parts"))
        scope.keep(parts)
    cut = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))

    def taken(words, parts, turn):
        # (a block that a quota ends in can be taken whole and in part: both are in the first row)
        some = F.filter(parts, lambda p: p["times"] > turn)
        return F.regexp_replace(F.array_join(F.flatten(F.transform(
            some, lambda p: F.slice(words, (p["at"] + 1).cast("int"), p["n"].cast("int")))), ""), r"[\x20\x09-\x0D]+$", "")

    # one struct holds the row, so that no column of it can clash; equal rows are one here and have all their parts
    rows = docs.select(key.alias("__row"), F.struct(*names).alias("row")).dropDuplicates(["__row"])
    turns = F.sequence(F.lit(0), F.array_max(F.transform("parts", lambda p: p["times"])).cast("int") - 1)
    joined = rows.join(parts.hint("merge"), "__row").select("row", F.col("row.text").alias("text"), "parts", F.explode(turns).alias("turn"))
    text = bind(cut, lambda w: taken(w, F.col("parts"), F.col("turn")))
    joined = joined.select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    return joined.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("row").getField(c)).alias(c) for c in names])


# query --------------------------------------------------------------------
def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    return taken_words(*mix(table(spark, sf_dir, "documents"))).select(
        "doc_id", "source", "size", "source_size", "target", "taken")
