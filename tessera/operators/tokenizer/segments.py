"""Many exact BPE merges per pass over the words.

A round takes the best pairs of the corpus, in the trainer's order (count
descending, then smaller ids), and calls them *hot*; ``last`` is the worst of
them. Words are cut wherever two neighbours are not a hot pair. What stays
between the cuts, added up over all words, is a small table of *segments* with
weights, and it alone decides the next merges exactly:

* An occurrence of a pair (X, Y) that merges of this round made stands on a
  neighbouring pair (x, y) of the round's start, x the last symbol of X and y
  the first of Y, and different occurrences stand on different ones. So
  ``count(X, Y) <= count(x, y)``, and a pair that beats ``last`` stands on hot
  pairs only: all its occurrences lie inside segments.
* On equal counts the order is by ids, and a symbol made in the round has a
  greater id than all before it. So (X, Y) does not come before (x, y), and
  the argument holds for ties as well.
* A merge never reaches over a cut, and a run of one symbol, which is merged
  from its left end, is never cut inside.

The round ends when the best pair of the segments comes after ``last``, or
after a merge that spells an older token, as that token's other pairs were
counted before.

The number of hot pairs is chosen so that the segments stay within a stated
number of symbols; with one hot pair they are runs of that pair alone. Nothing
else of the corpus reaches the driver, whatever its size.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = "ids array<int>, cnt long"


def pair_counts(words: DataFrame) -> DataFrame:
    """(l, r, c): neighbouring symbols and how often they occur, overlaps included."""
    n = F.size("ids")
    zipped = F.arrays_zip(F.slice("ids", 1, n - 1).alias("l"), F.slice("ids", 2, n - 1).alias("r"))
    return (words.select(F.explode(zipped).alias("p"), "cnt")
            .groupBy(F.col("p.l").alias("l"), F.col("p.r").alias("r")).agg(F.sum("cnt").alias("c")))


def hot_codes(pairs) -> np.ndarray:
    """The pairs as sorted 64-bit codes."""
    return np.sort(np.array([(left << 32) | right for left, right in pairs], dtype=np.int64))


def _segments(ids: pa.ListArray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, word offsets, segment starts, segment ends) of a batch of words."""
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    offsets = ids.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    if not len(flat):
        return flat, offsets, np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = (flat[:-1].astype(np.int64) << 32) | flat[1:]
    at = np.searchsorted(hot, codes)
    joined = hot[np.minimum(at, len(hot) - 1)] == codes
    inner = offsets[1:-1]
    joined[inner[(inner > 0) & (inner < len(flat))] - 1] = False
    starts = np.concatenate(([0], np.flatnonzero(~joined) + 1)).astype(np.int64)
    return flat, offsets, starts, np.append(starts[1:], len(flat))


def segment_counts(words: DataFrame, hot: Broadcast) -> DataFrame:
    """(ids, cnt): the different segments of two symbols or more and their total counts."""
    def cut(batches):
        for batch in batches:
            flat, offsets, starts, ends = _segments(batch.column(0), hot.value)
            counts = batch.column(1).to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(ends - starts > 1)
            word = np.searchsorted(offsets, starts[kept], side="right") - 1
            found: dict[bytes, int] = defaultdict(int)
            for s, e, c in zip(starts[kept], ends[kept], counts[word]):
                found[flat[s:e].tobytes()] += int(c)
            yield pa.record_batch([
                pa.array([np.frombuffer(k, dtype=np.int32) for k in found], pa.list_(pa.int32())),
                pa.array(list(found.values()), pa.int64())], names=["ids", "cnt"])
    return words.mapInArrow(cut, WORDS).groupBy("ids").agg(F.sum("cnt").alias("cnt"))


def rewrite(words: DataFrame, hot: Broadcast, merged: Broadcast) -> DataFrame:
    """The words after a round; ``merged`` gives the new symbols of each changed
    segment. Words left with one symbol go."""
    def swap(batches):
        for batch in batches:
            flat, offsets, starts, ends = _segments(batch.column(0), hot.value)
            keep = np.ones(len(flat), dtype=bool)
            table = merged.value
            for i in np.flatnonzero(ends - starts > 1):
                s, e = starts[i], ends[i]
                new = table.get(flat[s:e].tobytes())
                if new is not None:
                    symbols = np.frombuffer(new, dtype=np.int32)
                    flat[s:s + len(symbols)] = symbols
                    keep[s + len(symbols):e] = False
            place = np.concatenate(([0], np.cumsum(keep)))
            out = pa.ListArray.from_arrays(pa.array(place[offsets], pa.int32()), pa.array(flat[keep], pa.int32()))
            done = pa.record_batch([out, batch.column(1)], names=["ids", "cnt"])
            yield done.filter(pa.array(np.diff(place[offsets]) > 1))
    return words.mapInArrow(swap, WORDS)


class Segments:
    """The segments of a round as linked symbols; merges touch only where their pair stands."""

    def __init__(self, segments: list[np.ndarray], weights: list[int]):
        self.first, self.symbol, self.prev, self.next, self.weight = [], [], [], [], []
        self.count: dict[tuple[int, int], int] = defaultdict(int)
        self.where: dict[tuple[int, int], set[int]] = defaultdict(set)
        for ids, w in zip(segments, weights):
            base = len(self.symbol)
            self.first.append(base)
            n = len(ids)
            self.symbol.extend(ids.tolist())
            self.prev.extend([-1, *range(base, base + n - 1)])
            self.next.extend([*range(base + 1, base + n), -1])
            self.weight.extend([w] * n)
            for p in range(base, base + n - 1):
                pair = (self.symbol[p], self.symbol[p + 1])
                self.count[pair] += w
                self.where[pair].add(p)
        self.heap = [(-c, a, b) for (a, b), c in self.count.items()]
        heapq.heapify(self.heap)

    def best(self) -> tuple[int, int, int] | None:
        """(-count, left, right) of the next merge; None when no pair is left."""
        while self.heap:
            key = self.heap[0]
            now = self.count.get(key[1:], 0)
            if now == -key[0]:
                return key
            heapq.heappop(self.heap)
            if now > 0:
                heapq.heappush(self.heap, (-now, *key[1:]))
        return None

    def merge(self, left: int, right: int, new: int) -> None:
        """Replace ``left right`` by ``new`` wherever it stands, from the left in runs."""
        raised = set()
        for p in sorted(self.where.pop((left, right), ())):
            q = self.next[p]
            if self.symbol[p] != left or q < 0 or self.symbol[q] != right:
                continue
            w, before, after = self.weight[p], self.prev[p], self.next[q]
            if before >= 0:
                x = self.symbol[before]
                self.count[x, left] -= w
                self.count[x, new] += w
                self.where[x, new].add(before)
                raised.add((x, new))
            if after >= 0:
                y = self.symbol[after]
                self.count[right, y] -= w
                self.count[new, y] += w
                self.where[new, y].add(p)
                raised.add((new, y))
                self.prev[after] = p
            self.symbol[p], self.symbol[q] = new, -1
            self.next[p] = after
        self.count.pop((left, right), None)
        for pair in raised:
            if (c := self.count.get(pair, 0)) > 0:
                heapq.heappush(self.heap, (-c, *pair))

    def current(self):
        """The symbols of each segment, in the order given."""
        for p in self.first:
            ids = []
            while p >= 0:
                ids.append(self.symbol[p])
                p = self.next[p]
            yield np.array(ids, dtype=np.int32)


def learn(segments: Segments, last: tuple[int, int, int] | None, vocab: list[str], tok_id: dict[str, int],
          merges: list[tuple[str, str]], vocab_size: int, min_frequency: int) -> int:
    """Make all merges that come no later than ``last`` (None: no pair is cold),
    adding to ``vocab``, ``tok_id`` and ``merges``; returns how many."""
    made = 0
    while len(vocab) < vocab_size:
        key = segments.best()
        if key is None or -key[0] < min_frequency or (last is not None and key > last):
            break
        _, left, right = key
        token = vocab[left] + vocab[right]
        merges.append((vocab[left], vocab[right]))
        made += 1
        reused = token in tok_id
        if not reused:
            tok_id[token] = len(vocab)
            vocab.append(token)
        segments.merge(left, right, tok_id[token])
        if reused:
            break
    return made
