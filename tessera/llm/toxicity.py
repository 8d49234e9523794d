"""Toxicity from a learned lexicon, with misspellings and context.

Words, and word beginnings (stems), that occur almost only in documents
labelled toxic form the lexicon; their counts come from a Spark aggregation
over at most ``TOXIC`` + ``CLEAN`` labelled documents outside the held-out
fold. The lexicon is a trie. A word is looked up by running its Levenshtein
automaton (distance 1 from ``FUZZY_LENGTH`` letters on) along the trie: both
advance letter by letter, and a branch is left as soon as the automaton has no
live state. Words seen in the clean sample are never taken for misspellings.
All words of the sample are kept; its documents bound their number.

Each hit is scored in a window of ``WINDOW`` words: inside quotation marks,
or after a reporting word, it counts ``QUOTED`` of its weight (quotation);
otherwise all of it (abuse). A document's score is the logistic function of
its strongest hit and the sum of all.

Defined results: null, empty and wordless texts have no hits and the lowest
score; without toxic labels there is no lexicon and no hit; rows without
doc_id are never held out; repeated rows are scored one by one; a document
with conflicting labels counts as toxic; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bind, cut_lineage, hash_sample, narrow, python_ready, table, words_of
from .quality_pu import held_out

TOXIC, CLEAN = 4_000, 8_000           # labelled documents the lexicon is learnt from
CHANCE = 1e-6                         # an entry: as likely to stand in toxic documents only by chance
MAX_CLEAN_RATIO = 0.02                # and so few clean contexts for each toxic one
STEMS = (4, 5, 6)                     # letters of word beginnings that may be entries
STEM_WORDS = 4                        # distinct words a stem must begin
FUZZY_LENGTH = 5
WINDOW = 5
QUOTED = 0.3
FUZZY = 0.75
FOLDS, HELD_OUT = 5, 0
CACHE = 400_000

EDGE = " \t\n\x0b\x0c\r.,;:!?\"'()[]{}<>|&%$#*«»„“”‚‘’…-_"
QUOTES_OPEN, QUOTES_CLOSE = "\"'«„“‚‘", "\"'»“”‘’"
REPORTING = frozenset("""said says saying called calling quote quoted quotes wrote writes term word sagte schrieb zitat
nannte wort dit écrit appelé citation mot dijo escribió llamó cita palabra""".split())


class Lexicon:
    """Trie over exact entries and stems with their weights."""

    def __init__(self, entries: dict[str, float], stems: dict[str, float], known: frozenset):
        self.entries, self.stems, self.known = entries, stems, known
        self.root: dict = {}
        self.starts, self.ends = set(), set()
        for word, weight in entries.items():
            if len(word) >= FUZZY_LENGTH:
                node = self.root
                for c in word:
                    node = node.setdefault(c, {})
                node[""] = (word, weight)
                self.starts.add(word[:2])
                self.ends.add(word[-2:])
        self.stem_lengths = sorted({len(s) for s in stems})
        self.cache: dict[str, float] = {}

    def misspelt(self, word: str) -> float:
        """Weight of the best entry within one edit of ``word``. The states of
        the word's automaton are (letters read, edits); a trie branch is
        followed while some state is alive."""
        n, best = len(word), 0.0
        todo = [(self.root, frozenset(((0, 0), (1, 1))))]     # one letter of the word may be skipped at once
        while todo:
            node, states = todo.pop()
            if "" in node and (any(i == n for i, _ in states) or (n - 1, 0) in states):
                best = max(best, node[""][1])
            for c, child in node.items():
                if c == "":
                    continue
                step = set()
                for i, e in states:
                    if i < n and word[i] == c:
                        step.add((i + 1, e))
                        if e == 0 and i + 2 <= n:
                            step.add((i + 2, 1))              # then a letter of the word too many
                    if e == 0:
                        step.add((i, 1))                      # a letter of the entry left out
                        if i < n:
                            step.add((i + 1, 1))              # another letter instead
                if step:
                    todo.append((child, frozenset(step)))
        return best

    def weight(self, word: str) -> float:
        """How strongly a bare, lower-case word speaks for toxicity; 0: not at all."""
        found = self.cache.get(word)
        if found is None:
            found = self.entries.get(word, 0.0)
            for k in self.stem_lengths:
                if len(word) >= k and word[:k] in self.stems:
                    found = max(found, self.stems[word[:k]])
            if not found and len(word) >= FUZZY_LENGTH - 1 and (word[:2] in self.starts or word[-2:] in self.ends) \
                    and word not in self.known:
                found = FUZZY * self.misspelt(word)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def hits(self, text: str) -> list[tuple[str, float, bool]]:
        """(word, weight, quoted) of every hit in a text."""
        words = text.lower().split()
        bare = {w: w.strip(EDGE) for w in set(words)}
        weights = {w: x for w, b in bare.items() if b and (x := self.weight(b))}
        if not weights:
            return []
        out = []
        for k, w in enumerate(words):
            if w in weights:
                before, after = words[max(0, k - WINDOW):k + 1], words[k:k + WINDOW + 1]
                opened = any(x[0] in QUOTES_OPEN for x in before)
                closed = any(x.rstrip(".,;:!?")[-1:] in QUOTES_CLOSE and x.rstrip(".,;:!?") for x in after)
                quoted = (opened and closed) or any(x.strip(EDGE) in REPORTING for x in before[:-1])
                out.append((bare[w], weights[w], quoted))
        return out

    def score(self, text: str | None) -> tuple[float, int]:
        found = self.hits(text) if text else []
        each = [w * (QUOTED if quoted else 1.0) for _, w, quoted in found]
        z = -4.0 + (max(each) + 0.25 * math.log1p(sum(each)) if each else 0.0)
        return 1.0 / (1.0 + math.exp(-z)), len(found)


def learn(docs: DataFrame, labels: DataFrame, seed: int = 3) -> Lexicon:
    """The lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    per_doc = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))

    def some(toxic: int, bound: int) -> DataFrame:
        return hash_sample(per_doc.where(F.col("toxic") == toxic), "doc_id", bound, f"t{seed}")

    pick = some(1, TOXIC).unionByName(some(0, CLEAN))
    # a word counts once per pair of neighbours, so that copies of one document aren't evidence
    words = F.transform(words_of(F.lower("text")), lambda w: F.btrim(w, F.lit(EDGE)))
    around = bind(words, lambda w: F.transform(w, lambda x, i: F.struct(
        x.alias("word"), F.xxhash64(F.get(w, i - 1), F.get(w, i + 1)).alias("around"))))
    bare = docs.join(F.broadcast(pick), "doc_id").select("toxic", F.explode(around).alias("x")).select("toxic", "x.*") \
        .where("word <> ''").distinct()
    toxic, clean = F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    by_word = cut_lineage(bare.groupBy("word").agg(toxic, clean))
    n = {r["toxic"]: r["count"] for r in pick.groupBy("toxic").count().collect()}
    ratio = max(1, n.get(1, 0)) / max(1, n.get(0, 0))
    least = max(5, math.ceil(math.log(CHANCE) / math.log(ratio / (1 + ratio))))
    telling = (F.col("t") >= least) & (F.col("c") * ratio <= MAX_CLEAN_RATIO * F.col("t"))
    entries = by_word.where(telling).collect()
    known = by_word.where("c > 0").select("word").collect()
    stem = F.explode(F.array(*[F.substring("word", 1, k) for k in STEMS])).alias("stem")
    by_stem = by_word.where(F.length("word") >= min(STEMS)).select("word", "t", "c", stem).where(
        F.col("stem") != F.col("word")).groupBy("stem").agg(
        (F.sum("t") - F.max("t")).alias("t"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("k"))    # beside its commonest word
    stems = by_stem.where(telling & (F.col("k") >= STEM_WORDS)).collect()
    # of nested stems with the same evidence the longest is the most specific
    long = {r["stem"]: r["t"] for r in stems}
    less = {x[:k] for x in long for k in range(min(STEMS), len(x)) if x[:k] in long and long[x] >= 0.9 * long[x[:k]]}
    stems = [r for r in stems if r["stem"] not in less]

    def weight(r) -> float:
        return 4.0 + min(4.0, math.log((r["t"] + 0.5) / (r["c"] * ratio + 0.5)))

    return Lexicon({r["word"]: weight(r) for r in entries}, {r["stem"]: weight(r) for r in stems},
                   frozenset(r["word"] for r in known))


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, n_hits, predicted.
    ``labels`` (doc_id, toxic) teach outside the held-out fold only."""
    spark = docs.sparkSession
    python_ready(spark)
    d = narrow(docs, {"doc_id": "long", "text": "string"})
    teach = narrow(labels, {"doc_id": "long", "toxic": "int"}).where(~held_out(F.col("doc_id"), folds, fold))
    learnt = learn(d, teach)
    shared = spark.sparkContext.broadcast((learnt.entries, learnt.stems, learnt.known))   # the words of the bounded sample

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        lexicon = Lexicon(*shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                found = [lexicon.score(t) for t in part.column(2).to_pylist()]
                score = np.array([s for s, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(score), pa.array([n for _, n in found], pa.int64()),
                     pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "n_hits", "predicted"])

    return d.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, n_hits long, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT) -> DataFrame:
    """The rows of ``docs``, all columns, with a score below one half; one
    pass in place, without a join."""
    spark = docs.sparkSession
    python_ready(spark)
    teach = narrow(labels, {"doc_id": "long", "toxic": "int"}).where(~held_out(F.col("doc_id"), folds, fold))
    learnt = learn(narrow(docs, {"doc_id": "long", "text": "string"}), teach)
    shared = spark.sparkContext.broadcast((learnt.entries, learnt.stems, learnt.known))
    at = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        lexicon = Lexicon(*shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield part.filter(pa.array([lexicon.score(t)[0] < 0.5 for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


# query --------------------------------------------------------------------
def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
