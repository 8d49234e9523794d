"""Phrase collocation mining with vertically partitioned suffix subtrees.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and at
blanks and tabs into words. Phrases of 2 to ``max_words`` words that stand at
least ``min_count`` times in a language are candidates; their worst cut gives
the score ``floor(1000 * a * n / (l * r))``.

* Codes. Words are counted per language. Those with ``min_count`` occurrences
  get a number each, the ``dictionary`` most frequent; if there are more, the
  other words' code is a 62-bit hash. Rare words cut the pieces (no candidate holds one),
  so that a document is a short list of codes, staged once.
* Vertical partitioning. Every suffix of a piece, truncated to ``max_words``
  words, belongs to its shortest prefix that is not *heavy*: one that stands
  more than ``budget / 16`` times. Heavy prefixes of two words and more are found among those that are as
  dense in some stretch of the corpus (one pass; a heavy one must be), and
  counted exactly (another). Prefixes are dealt by hash to groups of half a
  budget on average, so that a group fits in one task's memory.
* Subtrees. Each group grows the tree of its suffixes alone, word by word; a
  node's count is the total of the suffixes below it, and nodes under
  ``min_count`` are not grown. Heavy prefixes' counts are those of the second
  pass. A run of suffixes travels as one block of packed codes.
* Scores, the drop of candidates inside an as frequent longer one, and the
  ranking are joins, aggregations and a window over the candidates, in exact
  decimals.

Defined results: null texts are empty and null languages are ``und``; rows
without doc_id count like any other, and so do repeated rows; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, narrow, python_ready, table

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
DICTIONARY = 1_000_000       # words whose numbers are sent to all tasks
BUDGET = 1_000_000           # suffixes of a group
MAX_HEAVY = 1_000_000        # prefixes that may be heavy, sent to all tasks; what counts as heavy doubles until they fit
RANK_PARTS = 64              # a language's candidates are first ranked in so many parts
HELD = 1_000_000             # words a task holds before it passes on counts or suffixes

_U = np.uint64
_CUT = b"\xff"               # no byte of UTF-8
#: A-Z lower-cased, what ends a piece to ``_CUT``
_BYTES = bytes(c + 32 if 65 <= c <= 90 else _CUT[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a text, with ``_CUT`` between pieces."""
    return text.translate(_BYTES).replace(_CUT, b" \xff ").split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the public splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x + _U(0x9E3779B97F4A7C15))
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def prefix_hash(suffixes: np.ndarray, words: int) -> np.ndarray:
    """64-bit hash (as int64) of the first ``words`` codes of each row."""
    h = np.full(len(suffixes), words, _U)
    for k in range(words):
        h = _mix(h ^ _mix(suffixes[:, k].astype(_U)))
    return h.view(np.int64)


def hash_code(word: bytes, lang: str) -> int:
    """Code of a word without a number: 62 bits, above all numbers."""
    from xxhash import xxh3_64_intdigest
    return xxh3_64_intdigest(lang.encode() + b" " + word) >> 2 | 1 << 62


def suffixes_of(codes: np.ndarray, words: int) -> np.ndarray:
    """All suffixes of two words or more, one row of ``words`` codes each:
    what follows after a cut (code 0) is 0."""
    padded = np.concatenate([codes, np.zeros(words, np.int64)])
    s = np.lib.stride_tricks.sliding_window_view(padded, words)[:len(codes)].copy()
    s = s[(s[:, 0] != 0) & (s[:, 1] != 0)] if words > 1 else s[s[:, 0] != 0]
    for k in range(1, words):
        s[s[:, k - 1] == 0, k] = 0
    return s


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        held: dict[str, Counter] = {}

        def counted():
            for lang, c in held.items():
                c.pop(_CUT, None)
                words = list(c)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()),
                                                  pa.array([c[w] for w in words], pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for part in parts:
            for lang, text in zip(part.column(0), part.column(1)):
                held.setdefault(lang.as_py(), Counter()).update(tokens(text.as_py()))
                if sum(map(len, held.values())) > HELD // 4:
                    yield from counted()
        yield from counted()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class _Codes(dict):
    """Codes of one language's words; other words are cut (0) or hashed."""

    def __init__(self, lang: str, whole: bool):
        self.lang, self.whole = lang, whole

    def __missing__(self, word: bytes) -> int:
        return 0 if self.whole else hash_code(word, self.lang)


def _encoded(docs: DataFrame, numbered, whole: bool) -> DataFrame:
    """(codes array<long>) of each text; ``numbered``: broadcast (langs, words, numbers)."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        known: dict[str, _Codes] = {}
        langs, words, numbers = numbered.value
        for lang, word, number in zip(langs, words, numbers):
            if lang not in known:
                known[lang] = _Codes(lang, whole)
            known[lang][word.encode()] = number
        for part in parts:
            for lo in range(0, part.num_rows, 256):
                some = part.slice(lo, 256)
                rows = []
                for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    if lang not in known:
                        known[lang] = _Codes(lang, whole)
                    code = known[lang]
                    code[_CUT] = 0
                    c = np.fromiter(map(code.__getitem__, tokens(text)), np.int64)
                    used = (c != 0) | (np.append(c[1:], 0) != 0)      # one zero between two runs is enough
                    rows.append(c[used])
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], names=["codes"])

    return docs.mapInArrow(run, "codes array<long>")


def _stretches(parts: Iterator, words: int) -> Iterator[tuple[np.ndarray, int]]:
    """The suffixes of ``HELD`` codes or so at a time, of batches of (codes), and the number of words."""
    held, size = [], 0

    def stretch():
        codes = np.concatenate(held)
        return suffixes_of(codes, words), int((codes != 0).sum())

    for part in parts:
        for lo in range(0, part.num_rows, 64):
            column = part.column(0).slice(lo, 64)
            flat, n = np.asarray(column.flatten()).astype(np.int64), np.asarray(column.value_lengths())
            # a zero after each document
            held.append(np.insert(flat, np.cumsum(n), 0))
            size += len(held[-1])
            if size >= HELD:
                yield stretch()
                held, size = [], 0
    if held:
        yield stretch()


def _dense(codes: DataFrame, share: int, total: int, words: int) -> DataFrame:
    """(codes array<long>, density) of the prefixes of two words and more that
    make up ``share / total`` of some stretch's words, and their greatest such
    part. All prefixes that stand ``share`` times in all are among them."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        for s, size in _stretches(parts, words):
            least = size * share / total
            for k in range(2, words + 1):
                h = prefix_hash(s, k)
                _, first, which, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                dense = n >= least
                rows = s[first[dense], :k]
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), k).cast(pa.list_(pa.int64())),
                                                      pa.array(n[dense] / size)], names=["codes", "density"])
                s = s[dense[which]]
                s = s[s[:, k] != 0] if k < words else s

    return codes.mapInArrow(run, "codes array<long>, density double").groupBy("codes").agg(F.max("density").alias("density"))


def _by_hash(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes of one length, ordered by their hash for ``_place``."""
    h = prefix_hash(rows, rows.shape[1])
    order = np.argsort(h)
    return h[order], rows[order]


def _place(s: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of the ``known`` prefixes each row of ``s`` starts with, else -1."""
    h, rows = known
    if not len(h) or not len(s):
        return np.full(len(s), -1)
    at = np.minimum(np.searchsorted(h, prefix_hash(s, rows.shape[1])), len(h) - 1)
    return np.where((rows[at] == s[:, :rows.shape[1]]).all(axis=1), at, -1)


def _counted(codes: DataFrame, known, words: int) -> DataFrame:
    """(codes array<long>, f): how often the ``known`` prefixes (broadcast, a
    list by length from 2 on) stand in all."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        n = [np.zeros(len(h), np.int64) for h, _ in known.value]
        for s, _ in _stretches(parts, words):
            for k, level in enumerate(known.value):
                at = _place(s, level)
                s = s[at >= 0]
                n[k] += np.bincount(at[at >= 0], minlength=len(n[k]))
        for (_, rows), f in zip(known.value, n):
            if f.any():
                yield pa.RecordBatch.from_arrays([pa.array(list(rows[f > 0]), pa.list_(pa.int64())), pa.array(f[f > 0])], names=["codes", "f"])

    return codes.mapInArrow(run, "codes array<long>, f long").groupBy("codes").agg(F.sum("f").alias("f"))


def _dealt(codes: DataFrame, heavy, groups: int, words: int) -> DataFrame:
    """(grp, n, block): every suffix in the group of its shortest prefix that
    is not heavy, packed in blocks. ``heavy``: broadcast, a list by length from 1 on."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        for s, _ in _stretches(parts, words):
            level, ship = np.ones(len(s), np.int64), np.ones(len(s), bool)
            todo = np.arange(len(s))
            for k, known in enumerate(heavy.value, 1):
                todo = todo[_place(s[todo], known) >= 0]
                if not len(todo):
                    break
                level[todo] = k + 1
                ends = s[todo, k] == 0 if k < words else np.ones(len(todo), bool)
                ship[todo[ends]] = False                   # counted as a heavy prefix, and no more words
                todo = todo[~ends]
            s, level = s[ship], level[ship]
            grp = prefix_hash(s, 1)
            for k in range(2, words + 1):
                some = level == k
                grp[some] = prefix_hash(s[some], k)
            grp = (grp.view(np.uint64) % _U(groups)).astype(np.int64)
            order = np.lexsort((s[:, 1], s[:, 0], grp))
            s, level, grp = s[order], level[order], grp[order]
            start = np.flatnonzero(np.diff(grp, prepend=-1))
            end = np.append(start[1:], len(grp)).astype(np.int64)[:len(start)]
            blocks = [pa.compress(np.concatenate([level[a:b][None], s[a:b].T]).tobytes(), "zstd", asbytes=True) for a, b in zip(start, end)]
            yield pa.RecordBatch.from_arrays([pa.array(grp[start]), pa.array(end - start), pa.array(blocks, pa.binary())],
                                             names=["grp", "n", "block"])

    return codes.mapInArrow(run, "grp long, n long, block binary")


def subtree_counts(s: np.ndarray, level: np.ndarray, min_count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nodes of the tree of the suffixes ``s`` (rows of codes, 0 after the
    end) below their prefixes of ``level`` words, with at least ``min_count``
    suffixes: (codes, counts) by length from 2 on."""
    out = []
    words = s.shape[1]
    node = np.zeros(len(s), np.int64)
    for k in range(1, words + 1):
        grows = s[:, k - 1] != 0
        s, level, node = s[grows], level[grows], node[grows]
        if not len(s):
            break
        _, code = np.unique(s[:, k - 1], return_inverse=True)
        _, first, node, n = np.unique(node * (int(code.max()) + 1) + code, return_index=True, return_inverse=True, return_counts=True)
        # all suffixes with the prefix that brought them here are here; shorter ones are counted as heavy
        below = level[first] <= k
        keep = n >= min_count
        if k > 1:
            out.append((s[first[keep & below], :k], n[keep & below]))
        stays = (keep | ~below)[node]
        s, level, node = s[stays], level[stays], node[stays]
    return out


def phrase_counts(codes: DataFrame, words: DataFrame, total: int, max_words: int, min_count: int, budget: int,
                  max_heavy: int) -> DataFrame:
    """(codes array<long>, f) of all phrases of 2 to ``max_words`` words with
    ``min_count`` occurrences. ``words``: (code, n) of the frequent words."""
    spark = codes.sparkSession
    if not total:
        return spark.createDataFrame([], "codes array<long>, f long")
    share = max(budget // 16, 1)
    dense = cut_lineage(_dense(codes, share, total, max_words))
    while dense.where(F.col("density") * total >= share).limit(max_heavy + 1).count() > max_heavy \
            or words.where(F.col("n") > share).limit(max_heavy + 1).count() > max_heavy:
        share *= 2

    def by_length(rows: DataFrame, lengths) -> list:
        listed = rows.select("codes").toArrow().column("codes").to_pylist()
        of = [np.array([x for x in listed if len(x) == k], np.int64).reshape(-1, k) for k in lengths]
        return [_by_hash(x) for x in of]

    maybe = by_length(dense.where(F.col("density") * total >= share), range(2, max_words + 1))
    counts = cut_lineage(_counted(codes, spark.sparkContext.broadcast(maybe), max_words).where(F.col("f") > share))
    single = words.where(F.col("n") > share).select(F.array("code").alias("codes"))
    heavy = by_length(single, [1]) + by_length(counts, range(2, max_words + 1))
    groups = max(1, -(-2 * total // budget))
    blocks = _dealt(codes, spark.sparkContext.broadcast(heavy), groups, max_words)

    def grow(group):
        import pyarrow as pa
        sizes = group.column("n").to_pylist()
        parts = [np.frombuffer(pa.decompress(b.as_py(), n * 8 * (max_words + 1), "zstd", asbytes=True), np.int64).reshape(max_words + 1, n)
                 for b, n in zip(group.column("block"), sizes)]
        held = np.concatenate(parts, axis=1)
        del parts
        rows, counts = [], []
        for c, n in subtree_counts(held[1:].T, held[0], min_count):
            rows += list(c)
            counts.append(n)
        return pa.table({"codes": pa.array(rows, pa.list_(pa.int64())),
                         "f": pa.array(np.concatenate([np.zeros(0, np.int64), *counts]).astype(np.int64))})

    grown = blocks.groupBy("grp").applyInArrow(grow, "codes array<long>, f long")
    return grown.unionByName(counts.where(F.col("f") >= min_count))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, percent: int = 100,
                 budget: int = BUDGET, dictionary: int = DICTIONARY, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """Per language of ``docs`` (text, lang) the ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    python_ready(spark)
    d = narrow(docs, {"lang": "string", "text": "string"}).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    counted = cut_lineage(_word_counts(d))
    totals = cut_lineage(counted.groupBy("lang").agg(F.sum("n").alias("total")))
    frequent = counted.where(F.col("n") >= min_count)

    # numbers by frequency, for as many words as are sent to all tasks
    numbered = frequent.orderBy(F.desc("n"), "lang", "word").limit(dictionary).toArrow()
    whole = numbered.num_rows < dictionary or frequent.limit(dictionary + 1).count() <= dictionary
    langs, names = numbered.column("lang").to_pylist(), numbered.column("word").to_pylist()
    shared = spark.sparkContext.broadcast((langs, names, list(range(1, len(names) + 1))))

    def coded(parts: Iterator) -> Iterator:
        import pyarrow as pa
        number = dict(zip(zip(*shared.value[:2]), shared.value[2]))
        for part in parts:
            code = [number.get((x, w)) or hash_code(w.encode(), x) for x, w in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(code, pa.int64())],
                                             names=["lang", "word", "n", "code"])

    words = cut_lineage(frequent.mapInArrow(coded, "lang string, word string, n long, code long"))
    codes = cut_lineage(_encoded(d, shared, whole))
    total = words.agg(F.sum("n")).first()[0] or 0
    found = cut_lineage(phrase_counts(codes, words, total, max_words, min_count, budget, max_heavy))

    # from codes to words
    placed = found.withColumn("id", F.monotonically_increasing_id()).select("id", "f", F.posexplode("codes").alias("place", "code"))
    spelt = placed.join(words.select("code", "lang", "word"), "code").groupBy("id").agg(
        F.first("lang").alias("lang"), F.first("f").alias("f"),
        F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias("w"))
    phrases = cut_lineage(spelt.select("lang", F.array_join("w", " ").alias("phrase"), "w", "f"))
    counts = phrases.select("lang", "phrase", "f").unionByName(words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")))

    # the worst cut of each candidate
    n_words = F.size("w")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), n_words - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, n_words), " ").alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]) \
        .join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("product", big("a") * big("total") * 1000).withColumn("parts", big("l") * big("r")) \
        .withColumn("score", F.expr("product div parts"))
    worst = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "total")).alias("c"))
    worst = worst.select("lang", "phrase", "c.a", "c.l", "c.r", F.col("c.total").alias("n"), "c.score")

    # candidates inside a longer one that is as frequent
    inside = phrases.where(n_words > 2).select("lang", F.col("f").alias("longer"), "w", F.explode(F.sequence(F.lit(2), n_words - 1)).alias("m")) \
        .select("lang", "longer", "w", "m", F.explode(F.sequence(F.lit(1), n_words - F.col("m") + 1)).alias("at")) \
        .select("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase"), "longer") \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = worst.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    order = Window.partitionBy("lang").orderBy(*order)
    return first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# query --------------------------------------------------------------------
def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, w[i:i + m - 1] AS w
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m))),
f AS (SELECT lang, phrase, min(m) AS m, min(w) AS w, count(*) AS f FROM g GROUP BY lang, phrase HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, w, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a::HUGEINT * t.n) // (x.f::HUGEINT * y.f) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
             JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ') JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
k AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM f q WHERE q.lang = b.lang AND q.f >= b.a AND q.phrase <> b.phrase
                                        AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM k QUALIFY rank <= 2000"""
