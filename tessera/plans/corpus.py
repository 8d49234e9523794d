"""End-to-end plans (compositions of the operators).

author_audit        X1  gate, flag, per-author counts, flag rule, list
clean_stories       X2  exclusion list, prepare gate, title, encode, length
                        gate, truncate, split
phase_corpus        X4  config, seeded take, split, encode to fixed length
long_story_corpus   X5  config, long-story filter, split, fixed length
sft_corpus          X6  seeded take, split, chat template, encode, truncate
chat_batches        X7  length-grouped batches, left padding, masked labels
doc_batches         X7  plain batches, right padding to batch max, labels
validate_saved      X8  read back, split sizes, head statistics, id range

Every plan takes an ``encode`` function ``Column(text) -> Column(ids)``;
the default is the byte variant (no merges), a trained BPE tokenizer
supplies its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import arrays as A
from ..functions import bytelevel as B
from ..functions import chat as CH
from ..operators import authors as AU
from ..operators import batching as BT
from ..operators import gates as G
from ..operators import order as O
from ..operators import stats as ST
from ..session import checkpoint_dir

Encoder = Callable[[Column], Column]


def author_audit(stories: DataFrame, patterns: Sequence[str], blocked_tags=C.EXCLUDE_GENRES,
                 blocked_warnings=C.EXCLUDE_WARNINGS, min_views=C.MIN_VIEWS) -> DataFrame:
    """Flagged authors with their counts and ratio."""
    stats = AU.author_stats(AU.flag_chapters(stories, patterns, blocked_tags, blocked_warnings, min_views))
    return AU.flagged_authors(stats).withColumn(
        "ratio", F.round(F.when(F.col("total") > 0, F.col("bad") / F.col("total")), 9))


def clean_stories(stories: DataFrame, excluded: DataFrame, encode: Encoder = B.byte_ids,
                  min_tokens: int = C.MIN_TOKENS, max_tokens: int = C.MAX_TOKENS,
                  test_fraction: float = C.TEST_FRACTION, blocked_tags=C.EXCLUDE_GENRES,
                  blocked_warnings=C.EXCLUDE_WARNINGS, min_views=C.MIN_VIEWS,
                  key: str = "doc_id") -> DataFrame:
    """(key, input_ids, length, author, split).

    The cheap gate runs first (its views comparison reaches the Parquet
    scan), then the anti-join, then encoding; the length gate uses the
    untruncated length and ``length`` is the truncated one."""
    kept = stories.where(G.prepare_keep(blocked_tags=blocked_tags, blocked_warnings=blocked_warnings,
                                        min_views=min_views))
    kept = AU.exclude_authors(kept, excluded)
    enc = kept.select(key, "author", encode(G.titled_text()).alias("__ids"))
    enc = enc.where(F.size("__ids") >= min_tokens) \
        .select(key, "author", A.truncate_head(F.col("__ids"), max_tokens).alias("input_ids"))
    enc = enc.withColumn("length", F.size("input_ids"))
    # encode once: the split reads the keys and then the rows, so the encoded
    # corpus is written once as a reliable checkpoint in the shared folder
    # (it survives executor loss; the original also saves it at this point)
    checkpoint_dir(enc.sparkSession)
    enc = enc.checkpoint(eager=True)
    return O.train_test_split(enc, key, test_fraction).select(key, "input_ids", "length", "author", "split")


def fixed_length(df: DataFrame, text: str, seq_len: int, encode: Encoder = B.byte_ids) -> DataFrame:
    """T12 body: encode, truncate, right-pad to ``seq_len`` with a mask. The
    byte variant truncates where it encodes."""
    ids = B.byte_ids(F.col(text), seq_len) if encode is B.byte_ids else encode(F.col(text))
    return df.withColumn("__ids", ids).withColumn("input_ids", A.pad_right(F.col("__ids"), seq_len)) \
        .withColumn("attention_mask", A.mask_right(F.col("__ids"), seq_len)).drop("__ids")


def phase_corpus(corpus: DataFrame, config: str | None, n_rows: int | None, seq_len: int,
                 test_fraction: float = C.TEST_FRACTION, encode: Encoder = B.byte_ids,
                 key: str = "doc_id") -> DataFrame:
    """(key, split, input_ids, attention_mask)."""
    df = corpus if config is None else corpus.where(F.col("config") == config)
    df = O.first_n(df.select(key, "text"), key, n_rows)
    df = O.train_test_split(df, key, test_fraction)
    return fixed_length(df, "text", seq_len, encode).select(key, "split", "input_ids", "attention_mask")


def long_story_corpus(corpus: DataFrame, config: str | None, seq_len: int,
                      min_tokens: int = C.LONG_STORY_MIN_TOKENS, test_fraction: float = C.TEST_FRACTION,
                      encode: Encoder = B.byte_ids, key: str = "doc_id") -> DataFrame:
    """Long stories only; the row target is not applied."""
    df = corpus if config is None else corpus.where(F.col("config") == config)
    df = G.long_story(df, min_tokens).select(key, "text")
    df = O.train_test_split(df, key, test_fraction)
    return fixed_length(df, "text", seq_len, encode).select(key, "split", "input_ids", "attention_mask")


def sft_corpus(conversations: DataFrame, n_rows: int | None, max_length: int,
               test_fraction: float = C.TEST_FRACTION, encode: Encoder = B.byte_ids,
               key: str = "conv_id") -> DataFrame:
    """(key, split, input_ids, length); chat template, truncation."""
    df = O.first_n(conversations, key, n_rows)
    df = O.train_test_split(df, key, test_fraction)
    ids = A.truncate_head(encode(CH.chatml_template(F.col("messages"))), max_length)
    return df.select(key, "split", ids.alias("input_ids")).withColumn("length", F.size("input_ids"))


def chat_batches(sft: DataFrame, batch_size: int, max_length: int, key: str = "conv_id",
                 seed: int = C.SEED) -> DataFrame:
    """X7 (chat): length-grouped batches, left padding, masked labels.

    Batch membership and batch maxima are planned on (key, length) only;
    the token arrays join that plan once and are padded row by row. ``sft``
    is read twice (narrow, then wide), so pass a saved table: the narrow
    read is then a two-column scan."""
    narrow = O.seeded_shuffle(sft.select(key, "length"), key, seed)
    plan = O.length_grouped_batches(narrow, "shuffle_idx", "length", batch_size)
    plan = BT.batch_lengths(plan, max_length=max_length).select(key, "batch_id", "row_in_batch", "pad_to")
    p = BT.pad_rows_left(sft.select(key, "input_ids").join(plan, key), max_length=max_length)
    return p.select(key, "batch_id", "row_in_batch", "input_ids", "attention_mask",
                    A.labels_masked(F.col("input_ids"), F.col("attention_mask")).alias("labels"))


def doc_batches(samples: DataFrame, batch_size: int, key: str = "doc_id", seed: int = C.SEED) -> DataFrame:
    """X7 (documents): seeded batches, right padding to the batch maximum,
    labels a plain copy. Planned on (key, length) like :func:`chat_batches`."""
    length = F.col("length") if "length" in samples.columns else F.size("input_ids")
    narrow = O.seeded_shuffle(samples.select(key, length.alias("length")), key, seed)
    plan = BT.batch_lengths(O.assign_batches(narrow, "shuffle_idx", batch_size)) \
        .select(key, "batch_id", "row_in_batch", "pad_to")
    p = BT.pad_rows_right(samples.select(key, "input_ids").join(plan, key))
    return p.select(key, "batch_id", "row_in_batch", "input_ids", "attention_mask",
                    A.labels_plain(F.col("input_ids")).alias("labels"))


def validate_saved(saved: DataFrame, vocab_size: int, key: str = "doc_id") -> DataFrame:
    """Split sizes, first-1000 length statistics of train and the id
    range check, as (metric, value) rows -- a union of one-row aggregates."""
    sizes = saved.agg(F.count_if(F.col("split") == "train").alias("n_train"),
                      F.count_if(F.col("split") == "test").alias("n_test"),
                      F.count_if(F.array_max("input_ids") >= vocab_size).alias("n_out_of_range"))
    head = ST.head_length_summary(ST.head_rows(saved.where(F.col("split") == "train"), key))
    return _metrics(sizes).unionByName(_metrics(head, prefix="head_"))


def _metrics(one_row: DataFrame, prefix: str = "") -> DataFrame:
    """One-row aggregate -> (metric, value) rows."""
    pairs = [F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("double").alias("value"))
             for c in one_row.columns]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select("m.metric", "m.value")
