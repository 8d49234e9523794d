"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased; keys found in at least ``min_docs`` documents are *repeated* and
lose all their lines in every document.

* A run is a table (128-bit key hash as hi and lo, n documents), bucketed by
  the hash and sorted within buckets, in the folder of ``spark.checkpoint.dir``.
  Joins with runs merge bucket by bucket: only the batch is shuffled.
* A batch's keys are counted, then merge-anti-joined with the runs' repeated
  keys, which need no more counting; the rest meets the runs' counts. What
  reaches ``min_docs`` is marked repeated, and the batch's own run is added
  at level 0. So a key that is repeated has exactly one row saying so.
* A level that holds ``fanout`` runs is compacted into one run of the next
  level, so that a batch meets at most ``fanout - 1`` runs a level. Only
  compaction shuffles runs, each row once a level.
* Lines are dropped map-side against the broadcast repeated hashes while they
  number at most ``broadcast_keys`` (16 bytes each), beyond that by joins on
  the hash and then on the hash of the whole text; both give the same rows.

Defined results: a null or empty text is one empty line, which is never
repeated; a key counts once a row, and repeated rows are separate documents;
null ids are kept; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import cut_lineage, drop_folder, narrow, python_ready, table

MIN_DOCS = 10
BATCHES = 4
FANOUT = 3
BROADCAST_KEYS = 2_000_000
HELD_KEYS = 500_000          # line hashes a task holds before it passes on their counts

_SPACE = b" \t\n\x0b\x0c\r"
_PAIR = np.dtype([("hi", "<i8"), ("lo", "<i8")])


def line_hashes(lines: list[bytes]) -> np.ndarray:
    """128-bit hashes (hi, lo) of the lines' keys; of empty keys zeros."""
    from xxhash import xxh3_128_digest
    keys = [x.strip(_SPACE) for x in lines]
    return np.frombuffer(b"".join([xxh3_128_digest(k) if k else bytes(16) for k in keys]), _PAIR)


def _lines(text: bytes | None) -> tuple[list[bytes], np.ndarray]:
    text = text or b""
    return text.split(b"\n"), line_hashes(text.lower().split(b"\n"))      # on bytes: A-Z only


class LineRuns:
    """The runs of one corpus. ``levels`` names the folders of each level's runs."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        if min_docs < 1 or fanout < 2:
            raise ValueError("min_docs must be 1 or more and fanout 2 or more")
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _path(self, name: str) -> str:
        return f"{checkpoint_dir(self.spark).rstrip('/')}/{name}"

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").option("path", self._path(name)).saveAsTable(name)
        return name

    def _together(self, names: list[str]) -> DataFrame:
        """The rows of several runs, read as plain files: a union of bucketed
        tables claims their partitioning and would not be merged by key."""
        return self.spark.read.schema("hi long, lo long, n long").parquet(*map(self._path, names))

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        drop_folder(self.spark, self._path(name))

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Take in a batch of counted keys (hi, lo, n); keys may repeat."""
        own = batch.groupBy("hi", "lo").agg(F.sum("n").alias("n"))
        for name in self.runs():
            known = self.spark.table(name).where(F.col("n") >= self.min_docs).select("hi", "lo")
            own = own.join(known.hint("merge"), ["hi", "lo"], "left_anti")
        total = F.col("n")
        for k, name in enumerate(self.runs()):
            seen = self.spark.table(name).where(F.col("n") < self.min_docs).select("hi", "lo", F.col("n").alias(f"n{k}"))
            own = own.join(seen.hint("merge"), ["hi", "lo"], "left")
            total = total + F.coalesce(F.col(f"n{k}"), F.lit(0))
        n = F.when(total >= self.min_docs, F.lit(self.min_docs).cast("long")).otherwise(F.col("n"))
        self.levels[0].append(self._write(own.select("hi", "lo", n.alias("n"))))
        self.compact()

    def compact(self) -> None:
        """Merge every full level into one run of the next."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                old = self.levels[level]
                n = F.least(F.sum("n"), F.lit(self.min_docs).cast("long"))
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(self._together(old).groupBy("hi", "lo").agg(n.alias("n"))))
                self.levels[level] = []
                for name in old:
                    self._remove(name)
            level += 1

    def repeated(self) -> DataFrame:
        """The repeated keys (hi, lo), each once; there must be a run."""
        return self._together(self.runs()).where(F.col("n") >= self.min_docs).select("hi", "lo")

    def close(self) -> None:
        for name in self.runs():
            self._remove(name)
        self.levels = [[]]


def counted_keys(texts: DataFrame, batches: int) -> DataFrame:
    """(batch, hi, lo, n) of the non-empty line keys of ``texts`` (one binary
    column): in how many rows of a stretch of the input they stand. A batch
    is every ``batches``-th split of the input."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        batch = TaskContext.get().partitionId() % batches
        held, size = [], 0

        def counted():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), batch, np.int32)), pa.array(keys["hi"].copy()),
                                               pa.array(keys["lo"].copy()), pa.array(n.astype(np.int64))], names=["batch", "hi", "lo", "n"])

        for part in parts:
            for text in part.column(0):
                keys = np.unique(_lines(text.as_py())[1])
                held.append(keys[(keys["hi"] != 0) | (keys["lo"] != 0)])
                size += len(keys)
                if size >= HELD_KEYS:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return texts.mapInArrow(run, "batch int, hi long, lo long, n long")


def _in(found: np.ndarray, known: np.ndarray, ties: int) -> np.ndarray:
    """Which hashes are among ``known``, sorted by hi with at most ``ties`` equal hi."""
    hit = np.zeros(len(found), bool)
    if len(known):
        at = np.searchsorted(known["hi"], found["hi"])
        for k in range(ties):
            near = known[np.minimum(at + k, len(known) - 1)]
            hit |= (near["hi"] == found["hi"]) & (near["lo"] == found["lo"])
    return hit


def _dropped_by_broadcast(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    listed = repeated.toArrow()
    known = np.empty(listed.num_rows, _PAIR)
    for c in ("hi", "lo"):
        known[c] = np.asarray(listed.column(c)).astype(np.int64)
    known = known[np.argsort(known["hi"], kind="stable")]
    ties = int(np.unique(known["hi"], return_counts=True)[1].max()) if len(known) else 0
    shared = docs.sparkSession.sparkContext.broadcast((known, ties))

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        known, ties = shared.value
        for part in parts:
            for lo in range(0, part.num_rows, 256):
                some = part.slice(lo, 256)
                texts, n, gone = [], [], []
                for text in some.column(1):
                    lines, keys = _lines(text.as_py())
                    hit = _in(keys, known, ties)
                    n.append(len(lines))
                    gone.append(int(hit.sum()))
                    texts.append(b"\n".join([x for x, h in zip(lines, hit.tolist()) if not h]).decode() if gone[-1]
                                 else (text.as_py() or b"").decode())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                                  pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

    return docs.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, text string")


def _dropped_by_join(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        for part in parts:
            for lo in range(0, part.num_rows, 256):
                some = part.slice(lo, 256)
                keys = [_lines(t.as_py())[1] for t in some.column(0)]
                n = np.array([len(k) for k in keys], np.int64)
                flat = np.concatenate(keys) if keys else np.zeros(0, _PAIR)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(np.arange(len(n)), n)
                held = (flat["hi"] != 0) | (flat["lo"] != 0)
                yield pa.RecordBatch.from_arrays(
                    [some.column(c).take(pa.array(row[held])) for c in (1, 2)]
                    + [pa.array(place[held].astype(np.int32)), pa.array(flat["hi"][held]), pa.array(flat["lo"][held])],
                    names=["t0", "t1", "place", "hi", "lo"])

    # equal texts lose the same lines, so a text's hash stands for it
    named = docs.withColumns({"t0": F.xxhash64("text"), "t1": F.xxhash64(F.lit(1), "text")})
    lines = named.select("text", "t0", "t1").mapInArrow(run, "t0 long, t1 long, place int, hi long, lo long")
    hits = lines.join(repeated.hint("merge"), ["hi", "lo"], "left_semi").groupBy("t0", "t1").agg(F.collect_set("place").alias("gone"))
    split = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    rows = named.join(hits.hint("merge"), ["t0", "t1"], "left").select(
        "doc_id", split.alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
                       F.array_join(F.filter("lines", lambda _, k: ~F.array_contains(F.col("gone"), k)), "\n").alias("text"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT,
                        broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_lines before dropping,
    n_dropped, and the text without its repeated lines."""
    spark = docs.sparkSession
    python_ready(spark)
    d = narrow(docs, {"doc_id": "long", "text": "string"}).select("doc_id", F.col("text").cast("binary").alias("text"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/line-batches-{uuid.uuid4().hex}"
    counted_keys(d.select("text"), batches).write.partitionBy("batch").parquet(path)
    counted = spark.read.schema("hi long, lo long, n long, batch int").parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for k in range(batches):
        runs.add(counted.where(F.col("batch") == k))
    drop_folder(spark, path)
    repeated = cut_lineage(runs.repeated())
    runs.close()
    if repeated.limit(broadcast_keys + 1).count() <= broadcast_keys:
        return _dropped_by_broadcast(d, repeated)
    return _dropped_by_join(d, repeated)


# query --------------------------------------------------------------------
def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
p AS (SELECT r, unnest(range(1, len(l) + 1)) AS place, unnest(l) AS line FROM d),
k AS (SELECT r, place, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM p),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
g AS (SELECT r, count(*) AS n_lines, count(f.key) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '') AS kept
      FROM k LEFT JOIN f ON k.key = f.key GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN g USING (r)"""
