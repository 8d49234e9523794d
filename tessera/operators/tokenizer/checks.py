"""Tokenizer data checks and comparisons over a corpus (T10, T11, A8-A10,
G8). Each is an aggregate over an encoded text column; totals need each
distinct pre-token encoded once only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import constants as C
from ...functions import bytelevel as B
from .train import BPEModel


def digit_token_ids(model: BPEModel) -> list[int]:
    """Ids of tokens that decode to more than one digit (must never occur)."""
    out = []
    for i, t in enumerate(model.vocab):
        if i < model.n_specials:
            continue
        raw = bytes(_S2B.get(ch, 0) for ch in t).decode("utf-8", "replace")
        if len(raw) > 1 and raw.isdigit():
            out.append(i)
    return out


_S2B = {s: b for b, s in B.byte_to_symbol().items()}


def tokenizer_checks(texts: DataFrame, text: str, encode, decode, model: BPEModel) -> DataFrame:
    """One row: rows checked; occurrences of multi-digit tokens; rows where an
    operator was split (operator occurrences in the text vs operator ids in
    the encoding); rows whose decode(encode(text)) is not the NFC text."""
    bad_ids = digit_token_ids(model)
    op_ids = [C.SPECIAL_IDS[o] for o in C.OPERATORS]
    ids = encode(F.col(text))
    enc = texts.select(F.col(text).alias("t"), ids.alias("ids"))
    n_ops_text = F.size(F.filter(B.special_token_counts(F.col("t")),
                                 lambda s: F.array_contains(F.array(*[F.lit(o) for o in C.OPERATORS]), s)))
    n_ops_ids = F.size(F.filter("ids", lambda i: i.isin(op_ids)))
    multi = F.size(F.filter("ids", lambda i: i.isin(bad_ids))) if bad_ids else F.lit(0)
    flags = enc.select(multi.alias("multi"), (n_ops_text != n_ops_ids).alias("op_split"),
                       (decode(F.col("ids")) != B.nfc(F.col("t"))).alias("rt_fail"))
    return flags.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.sum("multi").cast("long").alias("n_multi_digit_tokens"),
                     F.count_if("op_split").alias("n_operator_split"),
                     F.count_if("rt_fail").alias("n_roundtrip_fail"))


def _sizes(texts: DataFrame, text: str, tokenizers: dict, keep: list[str]) -> DataFrame:
    """One pass: the token count of every tokenizer side by side."""
    cols = [F.size(encode(F.col(text))).alias(f"__n{i}") for i, (encode, _) in enumerate(tokenizers.values())]
    return texts.select(*keep, F.length(text).alias("__chars"), *cols)


WORDS = "array<struct<word:string,chars:int>>"


def _totals(texts: DataFrame, text: str, tokenizers: dict, keys: list[str]) -> DataFrame:
    """Per key: texts, chars and the token total of every tokenizer.

    The texts are cut into pre-tokens once for all tokenizers and counted (map-side
    first); each distinct pre-token is then encoded once, and weighs its count. That
    equals the sum over the texts, as no token crosses a pre-token's bounds. A null
    pre-token stands for the text itself and carries its length."""
    # the length goes with its own element, so that no text is repeated for each of its words
    own = F.struct(F.lit(None).cast("string").alias("word"), F.length(text).alias("chars"))
    words = F.transform(B.raw_pretokens(F.col(text)),
                        lambda w: F.struct(w.alias("word"), F.lit(None).cast("int").alias("chars")))
    cut = texts.select(*keys, F.explode(F.concat(F.array(own), F.coalesce(words, F.array().cast(WORDS)))).alias("__w"))
    counted = cut.groupBy(*keys, F.col("__w.word").alias("__word")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__w.chars").alias("__chars"))
    whole = F.col("__word").isNull()
    cols = [F.when(~whole, F.size(encode(F.col("__word")))).alias(f"__n{i}") for i, (encode, _) in enumerate(tokenizers.values())]
    sizes = counted.select(*keys, "__n", "__chars", whole.alias("__whole"), *cols)
    # no words but a text: 0 tokens; no text at all: null, as its chars
    aggs = [F.sum(F.col("__n") * F.col(f"__n{i}")).alias(f"__t{i}") for i in range(len(tokenizers))]
    sums = sizes.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("__whole"), F.col("__n"))), F.lit(0)).alias("n_texts"),
                                    F.sum("__chars").alias("chars"), *aggs)
    return sums.select(*keys, "n_texts", "chars",
                       *[F.when(F.col("chars").isNotNull(), F.coalesce(f"__t{i}", F.lit(0))).alias(f"tokens{i}")
                         for i in range(len(tokenizers))])


def _long(one: DataFrame, tokenizers: dict, fields: list[str], keys: list[str]) -> DataFrame:
    """Wide per-tokenizer columns -> one row per tokenizer."""
    rows = [F.struct(F.lit(name).alias("tokenizer"), F.lit(vsize).alias("vocab_size"),
                     *[F.col(f"{f}{i}").alias(f) for f in fields])
            for i, (name, (_, vsize)) in enumerate(tokenizers.items())]
    return one.select(*keys, F.explode(F.array(*rows)).alias("t")).select(*keys, "t.*")


def efficiency(texts: DataFrame, text: str, tokenizers: dict) -> DataFrame:
    """Per tokenizer total chars, total tokens, chars per token, vocab
    size. ``tokenizers`` maps name -> (encode, vocab_size); every tokenizer
    encodes the same distinct pre-tokens of one pass over the texts."""
    one = _totals(texts, text, tokenizers, [])
    return _long(one, tokenizers, ["tokens"], ["chars"]).select(
        "tokenizer", F.col("chars").alias("total_chars"), F.col("tokens").alias("total_tokens"),
        F.round(F.col("chars") / F.col("tokens"), 6).alias("chars_per_token"), "vocab_size")


def ranking(eff: DataFrame) -> DataFrame:
    """Rank tokenizers by total tokens (fewer is better); mark the best.
    ``eff`` has one row per tokenizer, so the ordering window is tiny."""
    from pyspark.sql import Window
    w = Window.orderBy("total_tokens", "tokenizer")
    return eff.select("tokenizer", "total_tokens", "chars_per_token", "vocab_size",
                      F.rank().over(w).alias("rank"),
                      (F.col("total_tokens") == F.min("total_tokens").over(Window.partitionBy(F.lit(0))))
                      .alias("best"))


def single_token_coverage(terms: DataFrame, term: str, tokenizers: dict) -> DataFrame:
    """Per tokenizer, how many terms encode to exactly one token (one
    pass, one aggregation)."""
    sizes = _sizes(terms, term, tokenizers, [])
    aggs = [F.count_if(F.col(f"__n{i}") == 1).alias(f"single{i}") for i in range(len(tokenizers))]
    one = sizes.agg(F.count(F.lit(1)).alias("terms"), *aggs)
    return _long(one, tokenizers, ["single"], ["terms"]).select(
        "tokenizer", "single", "terms", F.round(F.col("single") / F.col("terms") * 100, 3).alias("pct"))


def token_counts_by_class(texts: DataFrame, text: str, cls: str, tokenizers: dict) -> DataFrame:
    """A10: per text class and tokenizer: texts, chars, tokens (one pass
    over the texts, then their distinct pre-tokens)."""
    one = _totals(texts, text, tokenizers, [cls])
    return _long(one, tokenizers, ["tokens"], [cls, "n_texts", "chars"]).select(
        "tokenizer", cls, "n_texts", "chars", "tokens")
