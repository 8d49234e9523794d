"""Embedding near-dup: a forest of random-projection trees.

Each tree splits the vectors by random directions, level by level. Split
points come from a bounded sample (``SAMPLE`` vectors; every vector is
indexed): of a node's middle quantiles, the one that parts the fewest pairs at
the threshold. How many it parts is estimated from how many sampled vectors
lie how close to it, both over all vectors and over those with sampled links,
so that a large group of near copies counts by its links. A node stays a leaf,
whatever its size, when one more split would leave its tree with less than the
share of such pairs from which all trees together miss ``MISS``. Splits
overlap: in each tree a vector also enters the leaf on the other side of the
split it lies closest to, if that is within ``SPILL``.
Vectors are compared exactly, in double precision, within leaves; pairs at or
above the threshold become links, and their components the groups.

* Identical vectors are one class (its smallest id stands for it, its size
  counts), so copies are never compared.
* A pair that meets in several leaves is counted in the first of them only.
  Links never leave a leaf as pairs: a leaf reports counts and, per
  connected set, one edge from each member to the smallest.
* A leaf above ``LEAF_BLOCK`` vectors is cut into blocks, and each pair of
  blocks is a group of its own: no task holds more than two blocks. A dense
  group that can't be split without losing its links costs all its pairs.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and rows without vec_id, have no links and are their
own component; vectors of different lengths never link; repeated rows are
separate vectors; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, hash_sample, narrow, python_ready, table
from .components import components

THRESHOLD = 0.95
TREES = 10
LEAF = 512                # vectors aimed at per leaf
LEAF_BLOCK = 4096         # vectors a group compares at once, per side
SAMPLE = 16_384           # vectors the split points are taken from
NODE_SAMPLE = 64          # sampled vectors from which a node is split
MISS = 0.001              # share of the pairs at the threshold that all trees together may miss
QUANTILES = np.linspace(0.2, 0.8, 13)     # of a node's sampled vectors: where it may be split
REFERENCES = 4096         # sampled vectors that the sample's links are counted against
SPILL = 0.02              # distance to a split within which a vector enters both sides
BROADCAST_LEAVES = 200_000
SEED = 5


_Z = np.linspace(0.0, 6.0, 601)
_TAIL = np.array([0.5 * math.erfc(z / math.sqrt(2)) for z in _Z])


class Forest:
    """Directions and split points of all trees for ``total`` unit vectors of
    one length, from a sample of them."""

    def __init__(self, sample: np.ndarray, total: int, leaf: int, trees: int, seed: int, threshold: float):
        dim = sample.shape[1]
        rng = np.random.default_rng([seed, dim])
        # the deepest path takes the largest share at each split
        self.depth = min(60, math.ceil(math.log(total / leaf) / -math.log(QUANTILES[-1]))) if total > leaf else 0
        self.trees = trees
        r = rng.standard_normal((trees, self.depth, dim))
        self.directions = r / np.linalg.norm(r, axis=2, keepdims=True)
        self.cuts: list[dict[int, float]] = []           # by tree: heap number of a split node -> split point
        gap = max(math.sqrt(max(0.0, 2 - 2 * threshold) / dim), 1e-9)     # of a pair at the threshold, along a direction
        least = 1 - MISS ** (1 / trees)                   # share of such pairs that a tree has to keep
        near = np.zeros(len(sample))
        for lo in range(0, len(sample) if self.depth else 0, 1024):
            near[lo:lo + 1024] = (sample[lo:lo + 1024] @ sample[:REFERENCES].T >= threshold).sum(axis=1)
        near[:REFERENCES] -= near[:REFERENCES] > 0        # not with itself
        for t in range(trees):
            cuts: dict[int, float] = {}
            level = {1: (np.arange(len(sample)), 1.0)}
            for d in range(self.depth):
                below: dict[int, tuple[np.ndarray, float]] = {}
                for node, (rows, kept) in level.items():
                    if len(rows) < NODE_SAMPLE or len(rows) * total <= leaf * len(sample):
                        continue
                    p = sample[rows] @ self.directions[t, d]
                    cut, parted = _split_point(p, near[rows], gap)
                    left = p < cut
                    if kept * (1 - parted) < least or left.all() or not left.any():
                        continue
                    cuts[node] = cut
                    below[2 * node], below[2 * node + 1] = [(rows[side], kept * (1 - parted)) for side in (left, ~left)]
                level = below
            self.cuts.append(cuts)

    def _walk(self, x: np.ndarray, t: int, turn: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's leaf in tree ``t``, turned the other way at level
        ``turn``, and its distances to the splits on its path (else infinite)."""
        node = np.ones(len(x), np.int64)
        gaps = np.full((len(x), self.depth), np.inf)
        for d in range(self.depth):
            kinds, back = np.unique(node, return_inverse=True)
            cut = np.array([self.cuts[t].get(k, np.nan) for k in kinds.tolist()])[back]
            inner = np.flatnonzero(~np.isnan(cut))
            if not len(inner):
                break
            gaps[inner, d] = x[inner] @ self.directions[t, d] - cut[inner]
            right = gaps[inner, d] >= 0
            if turn is not None:
                right ^= turn[inner] == d
            node[inner] = 2 * node[inner] + right
        return node, gaps

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees, 2): each unit vector's leaf in each tree, and the one it spills to (else -1)."""
        out = np.full((len(x), self.trees, 2), -1, np.int64)
        for t in range(self.trees):
            out[:, t, 0], gaps = self._walk(x, t)
            if self.depth:
                turn = np.abs(gaps).argmin(axis=1)
                rows = np.flatnonzero(np.abs(gaps[np.arange(len(x)), turn]) < SPILL)
                out[rows, t, 1] = self._walk(x[rows], t, turn[rows])[0]
        return out


def _split_point(p: np.ndarray, near: np.ndarray, gap: float) -> tuple[float, float]:
    """Of the quantiles of the projections ``p``, the one that parts the
    smallest share of pairs at the threshold, and that share: the larger one
    of all vectors' and of those weighted by their links ``near``."""
    cuts = np.quantile(p, QUANTILES)
    tails = np.interp(np.abs(p[None, :] - cuts[:, None]) / gap, _Z, _TAIL, right=0.0)
    parted = tails.mean(axis=1)
    if near.any():
        parted = np.maximum(parted, tails @ near / near.sum())
    best = int(np.lexsort((np.abs(QUANTILES - 0.5), parted))[0])
    return float(cuts[best]), float(parted[best])


def _unit(rows) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _shared_before(a: np.ndarray, b: np.ndarray, tree: int, leaf: int) -> np.ndarray:
    """Whether the rows' leaf lists meet in an earlier tree, or in this one at a smaller leaf."""
    out = np.zeros(len(a), bool)
    for t in range(tree + 1):
        for p in (0, 1):
            for q in (0, 1):
                same = (a[:, t, p] == b[:, t, q]) & (a[:, t, p] >= 0)
                out |= same & (a[:, t, p] < leaf) if t == tree else same
    return out


def compare(x: np.ndarray, lists: np.ndarray, sizes: np.ndarray, side: np.ndarray | None, tree: int, leaf: int,
            threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links among unit vectors ``x`` (with ``side``: only between different
    sides). Returns each row's number of vectors newly linked, and the first
    row of its connected set."""
    m = len(x)
    linked = np.zeros((m, m), bool)
    counts = np.zeros(m, np.int64)
    for lo in range(0, m, 256):
        near = x[lo:lo + 256] @ x.T >= threshold
        near[np.arange(len(near)), np.arange(lo, lo + len(near))] = False
        if side is not None:
            near &= side[lo:lo + 256, None] != side[None, :]
        # only pairs that meet here first: the others' links are known
        if 16 * np.count_nonzero(near) > near.size:
            for t in range(tree + 1):
                for p in (0, 1):
                    for q in (0, 1):
                        mine = lists[lo:lo + 256, t, p]
                        met = (mine >= 0) & (mine < leaf) if t == tree else mine >= 0
                        near &= ~((mine[:, None] == lists[None, :, t, q]) & met[:, None])
                if not near.any():
                    break
        else:
            i, j = np.nonzero(near)
            for at in range(0, len(i), 500_000):
                a, b = i[at:at + 500_000], j[at:at + 500_000]
                near[a, b] = ~_shared_before(lists[a + lo], lists[b], tree, leaf)
        counts[lo:lo + 256] = near @ sizes
        linked[lo:lo + 256] = near
    first = np.full(m, -1)
    for k in np.flatnonzero(linked.any(axis=1)):
        if first[k] < 0:
            reached = np.zeros(m, bool)
            reached[k] = True
            front = np.array([k])
            while len(front):
                step = np.zeros(m, bool)
                for at in range(0, len(front), 1024):
                    step |= linked[front[at:at + 1024]].any(axis=0)
                front = np.flatnonzero(step & ~reached)
                reached[front] = True
            first[reached] = k
    return counts, first


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF,
                 seed: int = SEED) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    python_ready(spark)
    d = narrow(vectors, {"vec_id": "long", "embedding": "array<double>"})
    sound = F.coalesce((F.size("embedding") > 0) & F.col("vec_id").isNotNull()
                       & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                       & F.exists("embedding", lambda v: v != 0), F.lit(False))
    d = cut_lineage(d.withColumn("sound", sound))
    classes = cut_lineage(d.where("sound").groupBy("embedding").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")))
    dims = [r[0] for r in classes.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1))).select("n").collect()]

    forests = {}
    for n in dims:
        own = classes.where(F.size("embedding") == n)
        total = own.count()
        sample = hash_sample(own, "id", SAMPLE, f"v{seed}", total).select("embedding") if total > leaf else None
        rows = _unit([r[0] for r in sample.collect()]) if total > leaf else np.zeros((0, n))
        forests[n] = Forest(rows, total, leaf, trees, seed, threshold)
    shared = spark.sparkContext.broadcast(forests)        # bounded by SAMPLE and TREES

    def route(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                b = whole.slice(lo, 4096)
                rows = b.column(0).to_pylist()
                ids, copies = np.asarray(b.column(1)), np.asarray(b.column(2))
                lengths = np.array([len(r) for r in rows])
                for n in np.unique(lengths).tolist():
                    at = np.flatnonzero(lengths == n)
                    x = _unit([rows[k] for k in at])
                    lists = shared.value[n].leaves(x)
                    for t in range(trees):
                        for s in (0, 1):
                            w = np.flatnonzero(lists[:, t, s] >= 0)
                            if len(w):
                                yield pa.RecordBatch.from_arrays([
                                    pa.array(np.full(len(w), n, np.int32)), pa.array(np.full(len(w), t, np.int32)),
                                    pa.array(lists[w, t, s]), pa.array(ids[at[w]]), pa.array(copies[at[w]]),
                                    pa.array([v.tobytes() for v in x[w]], pa.binary()),
                                    pa.array([v.tobytes() for v in lists[w]], pa.binary())],
                                    names=["dim", "tree", "leaf", "id", "copies", "x", "lists"])

    routed = classes.select("embedding", "id", "copies").mapInArrow(
        route, "dim int, tree int, leaf long, id long, copies long, x binary, lists binary")
    key = ["dim", "tree", "leaf"]
    large = cut_lineage(routed.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > LEAF_BLOCK)
                        .select(*key, F.ceil(F.col("m") / LEAF_BLOCK).cast("int").alias("k")))
    few = large.count()
    if few:
        routed = routed.join(F.broadcast(large) if few <= BROADCAST_LEAVES else large, key, "left")
    else:
        routed = routed.withColumn("k", F.lit(None).cast("int"))
    own = F.pmod(F.xxhash64("id", F.lit("block")), F.col("k")).cast("int")
    routed = routed.withColumn("own", F.when(F.col("k").isNull(), 0).otherwise(own))
    routed = routed.withColumn("other", F.explode(F.when(F.col("k").isNull(), F.array(F.lit(0)))
                                                  .otherwise(F.sequence(F.lit(0), F.col("k") - 1))))
    routed = routed.withColumn("b0", F.least("own", "other")).withColumn("b1", F.greatest("own", "other"))

    def within(group):
        import pyarrow as pa
        ids = np.asarray(group.column("id")).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        n, tree, leaf_ = (group.column(c)[0].as_py() for c in key)
        x = np.frombuffer(b"".join(group.column("x").to_pylist()), np.float64).reshape(len(ids), n)[order]
        lists = np.frombuffer(b"".join(group.column("lists").to_pylist()), np.int64).reshape(len(ids), trees, 2)[order]
        sizes = np.asarray(group.column("copies")).astype(np.float64)[order]
        b0, b1 = group.column("b0")[0].as_py(), group.column("b1")[0].as_py()
        side = None if b0 == b1 else np.asarray(group.column("own"))[order]
        counts, first = compare(x, lists, sizes, side, tree, leaf_, threshold)
        some = np.flatnonzero(first >= 0)
        return pa.table({"id": ids[some], "links": counts[some], "first": ids[first[some]]})

    found = cut_lineage(routed.groupBy(*key, "b0", "b1").applyInArrow(within, "id long, links long, first long")
                        .groupBy("id", "first").agg(F.sum("links").alias("links")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    group = components(found.select(F.col("id").alias("a"), F.col("first").alias("b")))
    per_class = classes.join(links, "id", "left").join(group, "id", "left").select(
        "embedding", F.lit(True).alias("sound"), F.col("copies"), F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "id").alias("component"))
    sound_rows = d.where("sound").join(per_class.drop("sound"), "embedding").select(
        "vec_id", (F.col("copies") - 1 + F.col("links")).cast("long").alias("n_links"),
        F.col("component").alias("component_id"))
    rest = d.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return sound_rows.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


# query --------------------------------------------------------------------
def op10_embedding_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs, exactly: what the forest finds when it loses no pair.
OP10_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON r.id = l.a),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.c AS component_id, coalesce(e.vec_id = m.c, false) AS kept
FROM embeddings e LEFT JOIN m ON e.vec_id = m.id LEFT JOIN n ON e.vec_id = n.a"""
