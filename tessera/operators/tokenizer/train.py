"""Byte-level BPE training as Spark jobs.

Data flow
---------
1. ``word_counts``: every text -> NFC -> byte-level pre-tokens -> byte
   symbols, numeric symbols isolated -> ``groupBy(word).count()``. This is
   the only pass over the corpus; the rest works on distinct words.
2. ``words``: each distinct word as its symbol ids with its count; one-symbol
   words cannot merge and are dropped.
3. Rounds (:mod:`.segments`): count the pairs, cut the words where a pair is
   not among the best, add up the segments between the cuts, learn from them
   hundreds of merges **exactly** as one-merge-at-a-time training would, and
   rewrite the words by segment.
4. Each round's words are a table in the shared checkpoint folder, so lineage
   is one round deep; the round before's is deleted.

The vocabulary, the merge list and one round's segments are on the driver; all
are bounded, by the vocabulary size and by ``max_symbols``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import constants as C
from ...functions import bytelevel as B
from ...session import checkpoint_dir, ship_package
from . import segments as SG


# T4 -----------------------------------------------------------------------
def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): training pre-token words in byte-symbol form, counted over
    the whole corpus. Raw pre-tokens are counted first (partial counts per
    task, one shuffle); the byte mapping and numeric split then run once per
    distinct pre-token, and a second small aggregation merges words that
    several pre-tokens share."""
    raw = (texts.select(F.explode(B.pretokenize(B.nfc(F.col(text)))).alias("raw"))
           .groupBy("raw").agg(F.count(F.lit(1)).alias("n")))
    return (raw.select(F.explode(B.word_pieces(F.col("raw"))).alias("word"), "n")
            .groupBy("word").agg(F.sum("n").alias("n")))


# T5 -----------------------------------------------------------------------
def base_alphabet(words: DataFrame, initial: list[str] = C.DIGITS) -> DataFrame:
    """(symbol): every byte symbol seen in the words, plus the initial
    alphabet, sorted by code point (ascending string order of one-char
    strings is code-point order)."""
    seen = words.select(F.explode(F.split("word", "")).alias("symbol")).where(F.col("symbol") != "")
    init = words.sparkSession.createDataFrame([(s,) for s in initial], "symbol string")
    return seen.union(init).distinct()


@dataclass
class BPEModel:
    """A trained tokenizer: ``vocab[i]`` is the token of id ``i``; ``merges``
    are (left, right) token pairs in rank order."""
    vocab: list[str]
    merges: list[tuple[str, str]] = field(default_factory=list)
    n_specials: int = len(C.SPECIAL_TOKENS)
    samples: int = 0

    @property
    def vocab_size(self) -> int:
        return len(self.vocab)

    def token_to_id(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.vocab)}


def byte_model() -> BPEModel:
    """The byte variant: specials + all 256 byte symbols, no merges."""
    return BPEModel([t for _, t in B.byte_variant_vocab()], [])


LAST_TRAIN_STATS: dict = {}


class _WordTable:
    """The words between rounds: a new table of the shared folder each round."""

    def __init__(self, spark):
        self.spark, self.path = spark, None
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/bpe-words-{uuid.uuid4().hex}"
        self.round = 0

    def put(self, words: DataFrame) -> DataFrame:
        old, self.path = self.path, f"{self.base}/{self.round}"
        self.round += 1
        words.write.parquet(self.path)
        if old:
            self._delete(old)
        return self.spark.read.schema(words.schema).parquet(self.path)

    def drop(self) -> None:
        self._delete(self.base)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _fitting_segments(words: DataFrame, pairs: list, n_hot: int, max_symbols: int):
    """(hot pairs, their codes as a broadcast, segments, weights): the first ``n_hot`` pairs, or
    half as many and so on, until their segments hold at most ``max_symbols`` symbols."""
    spark = words.sparkSession
    while True:
        hot = spark.sparkContext.broadcast(SG.hot_codes((r["l"], r["r"]) for r in pairs[:n_hot]))
        found = SG.segment_counts(words, hot).cache()
        size = found.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
        if size <= max_symbols or n_hot == 1:
            rows = found.toArrow()
            found.unpersist()
            return (pairs[:n_hot], hot, [np.array(x, dtype=np.int32) for x in rows["ids"].to_pylist()],
                    rows["cnt"].to_pylist())
        found.unpersist()
        hot.unpersist()
        n_hot = max(1, min(n_hot // 2, n_hot * max_symbols // size))


def train_bpe(texts: DataFrame, vocab_size: int = C.VOCAB_SIZE, text: str = "text",
              min_frequency: int = C.MIN_FREQUENCY, special_tokens: list[str] = C.SPECIAL_TOKENS,
              initial_alphabet: list[str] = C.DIGITS, hot_pairs: int = 500,
              max_hot_pairs: int = 50_000, max_symbols: int = 200_000) -> BPEModel:
    """Learn a byte-level BPE vocabulary of ``vocab_size`` tokens (specials
    included) from a text column.

    The merges equal those of one-merge-at-a-time training for any values of
    the last three parameters, which only set how much a round takes: it
    starts with ``hot_pairs`` and goes on with as many (up to
    ``max_hot_pairs``) as keep its segments near ``max_symbols`` symbols in
    total. Null and empty texts add no word; an empty table gives the specials
    and the initial alphabet. A single word longer than ``max_symbols`` that
    is all one pair is the only case beyond that bound."""
    spark = texts.sparkSession
    ship_package(spark)
    table = _WordTable(spark)
    wc = table.put(word_counts(texts, text))
    samples = texts.count()

    alphabet = sorted(r["symbol"] for r in base_alphabet(wc, initial_alphabet).collect())
    vocab = list(special_tokens)
    tok_id = {t: i for i, t in enumerate(vocab)}
    for s in alphabet:
        if s not in tok_id:
            tok_id[s] = len(vocab)
            vocab.append(s)
    # symbol -> id for the alphabet (<= 256 + specials entries): a literal map
    alpha = F.create_map(*[x for t, i in tok_id.items() for x in (F.lit(t), F.lit(i))])
    ids = F.transform(F.filter(F.split("word", ""), lambda c: c != ""), lambda c: F.element_at(alpha, c))
    words = table.put(wc.where(F.length("word") > 1).select(ids.alias("ids"), F.col("n").alias("cnt")))

    merges: list[tuple[str, str]] = []
    rounds = []
    n_hot = hot_pairs
    while len(vocab) < vocab_size:
        # one pair more than needed tells whether any is cold
        pairs = SG.pair_counts(words).where(F.col("c") >= min_frequency) \
            .orderBy(F.desc("c"), "l", "r").limit(n_hot + 1).collect()
        if not pairs:
            break
        top, hot, segments, weights = _fitting_segments(words, pairs, min(n_hot, len(pairs)), max_symbols)
        last = (-top[-1]["c"], top[-1]["l"], top[-1]["r"]) if len(top) < len(pairs) else None
        state = SG.Segments(segments, weights)
        made = SG.learn(state, last, vocab, tok_id, merges, vocab_size, min_frequency)
        size = sum(map(len, segments))
        rounds.append({"pairs": len(top), "segments": len(segments), "symbols": size, "merges": made})
        if len(vocab) >= vocab_size:
            break
        changed = {old.tobytes(): new.tobytes() for old, new in zip(segments, state.current())
                   if len(old) != len(new)}
        merged = spark.sparkContext.broadcast(changed)
        words = table.put(SG.rewrite(words, hot, merged))
        hot.unpersist()
        merged.unpersist()
        n_hot = max(1, min(max_hot_pairs, int(len(top) * min(4.0, max(0.25, 0.7 * max_symbols / size)))))
    table.drop()
    LAST_TRAIN_STATS.clear()
    LAST_TRAIN_STATS.update({"rounds": len(rounds), "merges": len(merges), "per_round": rounds})
    return BPEModel(vocab, merges, len(special_tokens), samples)
